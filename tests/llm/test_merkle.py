"""Merkle manifests against a tree built whole."""

import hashlib
import random
import zlib

import pytest

from coinsieve.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, place int, grp int, block int, n int, root int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def layers(nodes, arity=3):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    return out


def climbed(tree, place, leaf, arity=3):
    proof = ""
    for level in tree[:-1]:
        first = place // arity * arity
        run = level[first : first + arity]
        proof += "".join(run[: place - first] + run[place - first + 1 :])
        run[place - first] = leaf
        place, leaf = place // arity, sha("".join(run))
    return proof, leaf


def brute(rows):
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        clean = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
            clean = text.replace("\n", "")
        leaf, other = (sha(written(doc_id, source, lang, n_chars, t)) for t in (text, clean))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, other, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: layers([r[2] for r in sorted(groups[s])]) for s in order}
    top = layers([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for at, s in enumerate(order):
        for place, (_, _, leaf, other, doc_id) in enumerate(sorted(groups[s])):
            proof, subroot = climbed(trees[s], place, other)
            above, folded = climbed(top, at, subroot)
            out.append((doc_id, leaf, trees[s][-1][0], root, sha(proof + above), folded, folded == root))
    return sorted(out, key=str)


def manifest(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA)
    return sorted(map(tuple, merkle.document_manifest(docs.repartition(5), **kw).collect()), key=str)


def sample(n, sources, seed):
    draw = random.Random(seed)
    texts = ["", None, "a\nb", "é \n ü\n", "plain", "x" * 50_000 + "\n"]
    rows = [(i, draw.choice(texts) if draw.random() < 0.7 else f"t\n{i}", draw.choice(["en", None, ""]), draw.choice(sources), draw.choice([None, i])) for i in range(n)]
    return rows + rows[:3] + [(None, "no id", None, sources[0], 1), (None, "no id", None, sources[0], 1), (None, "other", None, sources[0], 1)]


@pytest.mark.parametrize("sources", [["a"], [None, "", "b", "é", "Z", "z" * 300], [f"s{i}" for i in range(40)]])
def test_manifest_equals_whole_tree(spark, sources):
    rows = sample(150, sources, len(sources))
    assert manifest(spark, rows) == brute(rows)


def test_blocks_of_blocks(spark):
    """Blocks of nine leaves: the hot source is four trees deep."""
    draw = random.Random(3)
    rows = [(i, f"t{i}\n", "en", draw.choice(["hot", "hot", "hot", *"abcdefghijklmnopqrs"]), i) for i in range(900)]
    assert manifest(spark, rows, block_levels=2) == brute(rows)


def test_single_rows_and_empty_tables(spark):
    for rows in ([(7, None, None, None, None)], [(1, "a", "b", "c", 1), (2, "a", "b", None, 1)], []):
        assert manifest(spark, rows) == brute(rows) if rows else manifest(spark, rows) == []


@pytest.mark.parametrize("arity", [2, 3, 4])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 64])
def test_appended_witnesses_fold_to_the_root(n, arity):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    trees = merkle.Subtrees(arity)
    for digest in digests:
        trees.append(digest)
    root = trees.close(merkle.levels_above(n, arity))
    assert root.hex() == layers([d.hex() for d in digests], arity)[-1][0]
    for place, digest in enumerate(digests):
        assert merkle.fold(digest, bytes(trees.witness[place]), place, n, arity) == (root, b"")
        changed = merkle.fold(b"0" * 32, bytes(trees.witness[place]), place, n, arity)[0]
        assert changed != root


def test_open_subtrees_already_hold_partial_witnesses():
    trees = merkle.Subtrees()
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(7)]
    for digest in digests:
        trees.append(digest)
    # The first two runs are complete, the third is open.
    assert bytes(trees.witness[0]) == digests[1] + digests[2]
    assert bytes(trees.witness[4]) == digests[3] + digests[5]
    assert bytes(trees.witness[6]) == b""
