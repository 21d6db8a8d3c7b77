"""Tokens, fingerprints, repeats, near copies and toxicity against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from coinsieve.llm import flat, membership, partenum, pieces, quartile, recompress, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, place string, score double, key bigint, words array<string>"

ODD = [
    None, "", " ", "   ", "\n\t\v\f\r \n", "a", "a b", "  two  spaces ", "a▁b ▁", "<s></s><0x0A><unk>", "日本語 テキスト",
    "😀😀 é \x00 \ufeff\u2028x", "ab" * 300, "-" * 90, "\x1c\x85\xa0 not spaces", "x" * 3000 + " " + "y" * 10, " " * 70 + "end",
]


def table(spark, texts, first=0, ids=None):
    """Rows with extra columns whose names are used inside the operators."""
    ids = ids or range(first, first + len(texts))
    rows = [(i, t, "p", 0.5, 1, ["w"]) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def phrases(seed, count, words, most):
    """Texts over few words, with passages copied from one another."""
    draw = random.Random(seed)
    texts = []
    for _ in range(count):
        kind = draw.random()
        text = [draw.choice(words) for _ in range(draw.randint(0, most))]
        if texts and kind < 0.5:
            other = draw.choice(texts).split()
            if other:
                a = draw.randrange(len(other))
                text[len(text) // 2 : len(text) // 2] = other[a : a + draw.randint(1, most)]
        if kind > 0.9:
            text = [draw.choice(words)] * draw.randint(1, most)
        texts.append(draw.choice([" ", "\n", "  "]).join(text))
    return texts


# --- subword pieces ------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    draw = random.Random(4)
    texts = [*ODD, *["".join(draw.choice("ab  \n.eélth1ooo") for _ in range(draw.randint(1, 50))) for _ in range(300)]]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = rows(pieces.encode_documents(table(spark, texts), MODEL, with_ids=True))
    for i, text in enumerate(texts):
        ids = model.encode(text or "", add_eos=True)
        assert got[i].ids == ids, text
        assert got[i].n_tokens == len(ids)
        assert got[i].decoded == model.decode(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_pieces_of_repeated_rows_and_no_rows(spark):
    assert pieces.encode_documents(table(spark, []), MODEL).count() == 0
    got = pieces.encode_documents(table(spark, ["a b", "a b", None], ids=[1, 1, None]), MODEL).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 1), (1, 3), (1, 3)]


# --- flat words ------------------------------------------------------------------


def test_flat_words_are_the_words():
    import pyarrow as pa

    texts = [t or "" for t in ODD] + ["x", "x y", "y x"]
    batch = pa.RecordBatch.from_arrays([pa.array(ODD + texts[-3:])], names=["text"])
    for size in (1, 40, 1 << 20):
        seen = []
        for a, b, data, at in flat.chunks(batch, "text", size):
            starts, ends, first = flat.find_words(data, at)
            for i in range(b - a):
                span = slice(first[i], first[i + 1])
                seen.append([bytes(data[s:e]).decode() for s, e in zip(starts[span], ends[span], strict=True)])
        assert seen == [WORD.findall(t) for t in texts]


def test_word_hash_depends_on_the_word_alone():
    data = np.frombuffer(b"ab ab b a ab", np.uint8)
    starts, ends, _ = flat.find_words(data, np.array([0, len(data)]))
    made = flat.hash_words(data, starts, ends).tolist()
    assert made[0] == made[1] == made[4] and len(set(made)) == 3


# --- substring dedup ---------------------------------------------------------------


def brute_kept(docs, size):
    """docs: (doc_id, text); the kept words and the number of removed ones."""
    first = {}
    for i, text in docs:
        w = WORD.findall(text or "")
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in docs:
        w = WORD.findall(text or "")
        gone = set()
        for p in range(len(w) - size + 1):
            if i is not None and first[tuple(w[p : p + size])] < i:
                gone |= set(range(p, p + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("size, rounds, hot", [(13, 2, 50_000), (3, 1, 50_000), (4, 3, 50_000), (5, 2, 1), (13, 2, 1)])
def test_repeats_equal_brute_force(spark, monkeypatch, size, rounds, hot):
    monkeypatch.setattr(recompress, "HOT_ANCHORS", 1 << 40)
    texts = [*ODD, *phrases(size, 120, ["a", "b", "c", "dd", "é"], 60), *phrases(9, 60, [str(i) for i in range(40)], 60)]
    got = recompress.dedupe_substrings(table(spark, texts), size, rounds, hot)
    made = {r.doc_id: (r.doc_id, r._rc_words, r._rc_removed, r._rc_kept) for r in got.collect()}
    assert made == {x[0]: x for x in brute_kept(list(enumerate(texts)), size)}
    assert {r.doc_id: r.text for r in got.collect()} == dict(enumerate(texts))


def test_repeats_with_shared_and_missing_ids(spark):
    long = " ".join(f"w{i}" for i in range(20))
    other = " ".join(f"v{i}" for i in range(20))
    docs = [(None, long), (5, long), (5, long), (5, other), (7, f"{other} x {long}"), (None, other)]
    got = recompress.kept_digests(table(spark, [t for _, t in docs], ids=[i for i, _ in docs])).collect()
    digest = {hashlib.sha256(k.encode()).hexdigest(): k for *_, k in brute_kept(docs, 13)}
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, digest[r.kept_sha256]) for r in got) == sorted(
        (i or 0, n, m, k) for i, n, m, k in brute_kept(docs, 13)
    )
    assert recompress.kept_digests(table(spark, [])).count() == 0


def test_cut_texts_keep_the_columns(spark):
    long = " ".join(f"w{i}" for i in range(15))
    df = table(spark, [long, f"a  {long}\nb", "a\n b"]).withColumn("n_chars", F.length("text").cast("bigint"))
    made = recompress.without_repeats(df)
    assert made.columns == df.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in made.collect()} == {0: (long, len(long)), 1: ("a b", 3), 2: ("a\n b", 4)}


# --- n-gram Jaccard join --------------------------------------------------------------


def brute_components(docs, n, num, den):
    def shingles(text):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both * den >= num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if sets[i] and doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def near_copies(seed):
    draw = random.Random(seed)
    texts = []
    for size in (4, 12, 30, 90, 260):
        base = [f"{draw.choice('xyz')}{draw.randrange(400)}" for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, size // 25))):
                copy[draw.randrange(size)] = f"q{draw.randrange(1000)}"
            texts.append(" ".join(copy) if draw.random() < 0.8 else " ".join(copy).upper())
    return texts


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (1, 60, 100), (2, 1, 1)])
def test_components_equal_brute_force(spark, n, num, den):
    texts = [*ODD, *near_copies(n), *phrases(n, 60, ["a", "b", "c", "d"], 12)]
    docs = list(enumerate(texts))
    got = partenum.jaccard_components(table(spark, texts), n, num, den).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(docs, n, num, den))


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80)])
def test_a_large_group_of_edited_copies(spark, monkeypatch, n, num):
    """Copies of one text, most too far from it and from each other, some linked in pairs and chains."""
    draw = random.Random(num)
    base = [f"w{draw.randrange(500)}" for _ in range(140)]

    def edited(words, times):
        out = list(words)
        for _ in range(times):
            place, kind = draw.randrange(len(out)), draw.random()
            if kind < 0.6:
                out[place] = f"q{draw.randrange(100_000)}"
            elif kind < 0.8:
                del out[place]
            else:
                out.insert(place, base[draw.randrange(140)])
        return out

    texts = [edited(base, draw.choice([0, 1, 3, 6, 10, 14])) for _ in range(130)]
    far = [edited(base, 12) for _ in range(8)]
    texts += [edited(f, draw.randint(0, 2)) for f in far for _ in range(4)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    reached = []
    once = partenum.linked_by_differences
    monkeypatch.setattr(partenum, "linked_by_differences", lambda *a: reached.append(1) or once(*a))
    got = partenum.jaccard_components(table(spark, [t for _, t in docs]), n, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(docs, n, num, 100))
    assert reached and len({r.component_id for r in got}) > 20


def test_edited_copies_are_joined_only_where_enough_can_be_shared(spark, monkeypatch):
    """Edits at few places, so that many copies share some differences but few share enough."""
    draw = random.Random(7)
    around, sets = [], {}
    for b in range(1, 401):
        times = draw.choice([2, 4, 4, 4])
        lost = {5 * place + i for place in draw.sample(range(12), times) for i in range(5)}
        gained = {1000 + 5 * draw.randrange(30) + i for _ in range(times // 2) for i in range(5)}
        own = {10_000 + 100 * b + i for i in range(5 * times // 2)}
        sets[b] = set(range(146)) - lost | gained | own if b % 10 else sets[b - 1] - {min(sets[b - 1])}
        d = sorted(sets[b] ^ set(range(146)))
        around.append((0, 0, b, False, 146, len(sets[b]), d))
    linked = [b for b, s in sets.items() if 100 * len(s & set(range(146))) >= 80 * len(s | set(range(146)))]
    labels = spark.createDataFrame([(b, 0) for b in [0, *linked]], "key bigint, label bigint")
    around = spark.createDataFrame(around, "family bigint, a bigint, b bigint, links boolean, size_a int, size_b int, d array<bigint>")
    rows = []
    once = partenum.sharing

    def counted(*a):
        joined = once(*a)
        rows.append(joined.count())
        return joined

    monkeypatch.setattr(partenum, "sharing", counted)
    got = {tuple(r) for r in partenum.linked_by_differences(around, labels, 80, 100).collect()}
    inside = set(linked)
    want = {
        (x, y) for x in sets for y in sets
        if x < y and not (x in inside and y in inside) and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])
    }
    assert got == want and want
    assert rows[0] < 40_000


def rows_of_generates(plan):
    """Rows that the Generate nodes of a plan that ran have made."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return rows_of_generates(plan.executedPlan())
    if name.endswith("QueryStage"):
        return rows_of_generates(plan.plan())
    made = plan.metrics().apply("numOutputRows").value() if name == "Generate" else 0
    children = plan.children()
    return made + sum(rows_of_generates(children.apply(i)) for i in range(children.size()))


def test_members_come_once_for_each_bucket_that_can_give_what_they_ask_for(spark):
    """Members far from the centre that share two differences at most: nearly none is a candidate."""
    rows = [(0, b, b, True, 146, 146, [1000 * b + i for i in range(16 + b % 60)] + [1, 2], 2) for b in range(1, 301)]
    rows.append((0, 301, 301, True, 146, 146, [*range(5000, 5016), 1, 2], 2))
    rows = spark.createDataFrame(
        rows, "family bigint, b bigint, label bigint, outside boolean, size_a int, size_b int, d array<bigint>, common bigint"
    )
    joined = partenum.sharing(rows, 1 / 9)
    # asks = |d| - 146 / 9; a pair that shares two may ask for two on average.
    want = {(x, y) for x in [*range(60, 301, 60), 301] for y in [*range(60, 301, 60), 301] if x < y}
    assert {(r.x, r.y) for r in joined.collect()} == want
    assert rows_of_generates(joined._jdf.queryExecution().executedPlan()) < 300


def test_a_filter_is_as_large_as_its_values_need(spark):
    values = [random.Random(3).getrandbits(63) for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    bitmap = membership.build_filter(df, F.col("v"), membership.bits_for(len(values)))
    assert membership.maybe(bitmap, np.array(values)).all() and len(bitmap) == 1 << 12
    assert [membership.bits_for(n) for n in (0, 1, 2**20, 2**40)] == [15, 15, 26, 27]


def test_components_with_shared_and_missing_ids(spark):
    texts = ["a b c d", "A b C d", "a b c d", None, "", "x", "x"]
    ids = [4, 3, 4, 1, 1, None, None]
    got = partenum.jaccard_components(table(spark, texts, ids=ids), 3, 90, 100).collect()
    want = brute_components(list(zip(ids, texts, strict=True)), 3, 90, 100)
    assert sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in got) == sorted((a or 0, b, c or 0) for a, b, c in want)
    assert partenum.jaccard_components(table(spark, [])).count() == 0


def test_every_linking_pair_shares_a_signature():
    draw = random.Random(1)
    for num in (60, 80, 90, 95):
        bands = partenum.Bands(num, 100)
        for _ in range(150):
            size = draw.choice([1, 2, 5, 9, 20, 45, 130, 400])
            a = {draw.getrandbits(64) for _ in range(size)}
            b = set(a)
            while True:
                one = set(b)
                if draw.random() < 0.5 and len(one) > 1:
                    one.discard(draw.choice(sorted(one)))
                else:
                    one.add(draw.getrandbits(64))
                if 100 * len(a & one) < num * len(a | one):
                    break
                b = one
            made = [set(partenum.signatures(np.array(sorted(x), np.uint64), bands).tolist()) for x in (a, b)]
            assert made[0] & made[1], (num, len(a), len(b))


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", "other words", None, "", "other words"]
    df = table(spark, texts, ids=[3, 2, 2, 9, 5, 6, None])
    kept = partenum.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 5, 6, 9]


# --- fingerprints --------------------------------------------------------------------


def test_fingerprints_and_next_documents(spark):
    texts = [*ODD, *phrases(2, 80, [str(i) for i in range(30)], 80)]
    ids = [7 * i % 101 for i in range(len(texts))]
    got = rows(quartile.fingerprint_documents(table(spark, texts, ids=ids)))
    docs = sorted((i, t or "") for i, t in zip(ids, texts, strict=True))

    def digest(text):
        return quartile.digests([text.encode()])[1][0]

    def near(a, b):
        return 1 - quartile.difference(digest(a), digest(b)) / quartile.BOUND

    for (i, text), (_, after) in zip(docs, [*docs[1:], docs[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (digest(text), digest(edited))
        assert r.near_edited == pytest.approx(near(text, edited)) and r.near_next == pytest.approx(near(text, after))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


MASK = (1 << 64) - 1


def plain_numbers(text):
    """Header and bucket codes of a text, counted byte by byte."""
    data, counts = text.encode(), [0] * 256
    for i in range(len(data)):
        for salt, places in enumerate([(0, 1, 2), (0, 1, 3), (0, 2, 3)]):
            if i + places[2] < len(data):
                a, b, c = (data[i + k] for k in places)
                h = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35 + salt * 0x27D4EB2F + 1) % 2**32
                h = (h ^ h >> 15) * 0x2C1B3C6D % 2**32
                counts[h >> 24] += 1
    q1, q2, q3 = (sorted(counts)[256 * k // 4 - 1] for k in (1, 2, 3))
    total = sum((byte + 1) * (2 * i + 1) for i, byte in enumerate(data)) & MASK
    total ^= total >> 31
    total = total * 0x7FB5D329728EA185 & MASK
    total ^= total >> 27
    total = total * 0x81DADEF4BC2DD44D & MASK
    total ^= total >> 33
    length = min(int(math.log(len(data) + 1) / math.log(1.1) + 1e-12), 255)
    codes = [(c > q1) + (c > q2) + (c > q3) for c in counts]
    return [length, 15 * q1 // max(q3, 1), 15 * q2 // max(q3, 1), total >> 56, *codes]


def plain_digest(n):
    packed = [n[i] << 6 | n[i + 1] << 4 | n[i + 2] << 2 | n[i + 3] for i in range(4, 260, 4)]
    return bytes([n[0], n[1] * 16 + n[2], n[3], *packed]).hex()


def plain_likeness(a, b):
    far = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(x - y)] for x, y in zip(a[4:], b[4:], strict=True))
    far += 2 * abs(a[0] - b[0]) + 4 * (abs(a[1] - b[1]) + abs(a[2] - b[2])) + (a[3] != b[3])
    return 1 - min(far, 512) / 512


def test_fingerprints_equal_counting_by_hand(spark):
    draw = random.Random(21)
    texts = ["", "a", "abc", "abcd", None, "é" * 40, "the same text", "the same text"]
    texts += ["".join(draw.choice("abcdefgh  \n") for _ in range(draw.randint(1, 900))) for _ in range(30)]
    got = {r.doc_id: r for r in quartile.fingerprint_documents(table(spark, texts)).collect()}
    whole = [t or "" for t in texts]
    for i, text in enumerate(whole):
        after = whole[(i + 1) % len(whole)]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, changed, following = (plain_numbers(t) for t in (text, edited, after))
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (plain_digest(own), plain_digest(changed))
        assert got[i].near_edited == pytest.approx(plain_likeness(own, changed), abs=1e-12)
        assert got[i].near_next == pytest.approx(plain_likeness(own, following), abs=1e-12)


def test_fingerprints_of_few_rows(spark):
    assert quartile.fingerprint_documents(table(spark, [])).count() == 0
    (one,) = quartile.fingerprint_documents(table(spark, ["abcdef"])).collect()
    assert one.near_next == 1.0
    got = quartile.fingerprint_documents(table(spark, ["b", "a", "c"], ids=[1, 1, None])).collect()
    assert sorted(r.n_chars for r in got) == [1, 1, 1]


def test_difference_is_bounded_and_grows_with_edits():
    draw = random.Random(3)
    text = " ".join(str(draw.randrange(1000)) for _ in range(800))
    digests = [quartile.digests([t.encode()])[1][0] for t in (text, text[:-20], text[:2000], "z" * 4000)]
    gaps = [quartile.difference(digests[0], d) for d in digests]
    assert gaps[0] == 0 and gaps[1] < gaps[2] <= gaps[3] <= quartile.BOUND


# --- toxicity ----------------------------------------------------------------------------


def toxic_corpus(spark):
    draw = random.Random(5)
    plain = ["the", "river", "stone", "under", "green", "walks", "slowly", "bread", "music", "window"]
    bad = ["idiot", "moron", "scumbag"]
    rows, labels = [], []
    for i in range(400):
        words = [draw.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[draw.randrange(30)] = draw.choice(bad)
            words[draw.randrange(30)] = draw.choice(bad)
        rows.append(" ".join(words))
        labels.append((i, int(toxic)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxic_documents_are_told_apart(spark):
    docs, labels = toxic_corpus(spark)
    hidden = ["the river 1d10t under green moooooron", "music i d i o t bread m.o.r.o.n window", "the green river walks slowly", None, ""]
    got = rows(toxicity.score_documents(docs.union(table(spark, hidden, first=1000)), labels))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in truth if got[i].held_out]
    assert held and all(got[i].predicted == truth[i] for i in held)
    assert got[1000].predicted == 1 and got[1001].predicted == 1
    assert got[1002].predicted == 0 and got[1003].score == got[1004].score < 0.5
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i in held if not truth[i]}


def test_spellings_are_restored(spark):
    docs, _ = toxic_corpus(spark)
    restorer = toxicity.Restorer(toxicity.character_model(docs))
    assert restorer.restore("1d10t") == "idiot" and restorer.restore("m0r0n") == "moron"
    assert restorer.restore("idiooooot") == "idiot" and restorer.restore("i d i o t", True).replace(" ", "") == "idiot"
    assert "idiot" in restorer.words("you 1d1ot!") and "river" in restorer.words("the river.")


def test_decoding_equals_enumeration(spark):
    """Every spelling of short tokens, scored one by one: none is likelier than the decoded one."""
    import itertools

    docs, _ = toxic_corpus(spark)
    model = toxicity.character_model(docs)
    restorer = toxicity.Restorer(model)
    draw = random.Random(8)

    def likelihood(letters, cost):
        numbers = [0, 0, *[toxicity.letter_number(c) for c in letters], 0]
        return cost + sum(float(model[a][b][c]) for a, b, c in zip(numbers, numbers[1:], numbers[2:], strict=False))

    tokens = ["@$$", "5#17", "1d10t", "*#%*", "m00r0n", "(*+$|", "####1"]
    tokens += ["".join(draw.choice("aiot@$!1*#0+") for _ in range(draw.randint(1, 5))) for _ in range(120)]
    for token in tokens:
        best = {}
        for made in itertools.product(*[restorer.options(token, i, False) for i in range(len(token))]):
            letters, cost = "".join(c for c, _ in made), sum(c for _, c in made)
            best[letters] = max(best.get(letters, -1e9), likelihood(letters, cost))
        assert best[restorer.restore(token)] == pytest.approx(max(best.values()), abs=1e-4), token


def test_signs_without_letters_are_decoded(spark):
    docs, _ = toxic_corpus(spark)
    restorer = toxicity.Restorer(toxicity.character_model(docs))
    for token, tried in (("@$$", True), ("5#17", True), ("$100", False), ("100%", False), ("2024", False), ("1+1", True)):
        assert bool(toxicity.SIGNS_ALONE.match(token)) == tried
    assert restorer.words("so !d!0+ they say") >= {"so", "they", "say"} and len(restorer.words("so @$# say")) == 3


def test_scores_without_labels(spark):
    docs, labels = toxic_corpus(spark)
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert {r.score for r in toxicity.score_documents(docs, few).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
