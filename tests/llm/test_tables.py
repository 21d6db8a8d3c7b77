"""Mixing, neighbours, archives, URLs, dialogues and the pipeline against brute force."""

import base64
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from coinsieve.llm import dialogue, mixing, neighbours, urls, warc
from coinsieve.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing -------------------------------------------------------------------------


def brute_targets(sizes):
    """Targets of sources from their sizes."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in left) if left else 0
        new = {s for s in left if level * weight[s] >= 2 * sizes[s]}
        if not new:
            break
        full |= new
    return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in order}


def mix_docs(spark):
    draw = random.Random(6)
    rows = [(i, " ".join(["w"] * draw.randint(0, 60)), draw.choice(["b", "a", "é", "Z", None]), "x") for i in range(400)]
    rows += [(500, None, "a", "x"), (501, "", "empty", "x"), (502, " one\ttwo ", "a", "x"), (503, "z " * 5000, "b", "x"), (7, rows[7][1], rows[7][2], "x")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string")


def test_mix_meets_targets(spark):
    rows, docs = mix_docs(spark)
    got = mixing.mix_table(docs).collect()
    sizes, taken = {}, {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    targets = brute_targets(sizes)
    text_of = {(i, s): t for i, t, s, _ in rows}
    source_of = {i: s for i, _, s, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        source = source_of[r.doc_id]
        assert r.size == len(WORD.findall(text_of[r.doc_id, source] or ""))
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - targets[source]) <= max(5, 0.02 * targets[source]), source
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_table(docs.repartition(7)).collect()))


def long_and_short():
    draw, rows = random.Random(9), []
    for s in range(40):  # one or five very long documents among short ones
        sizes = [max(5, int(draw.lognormvariate(3.5, 0.7))) for _ in range(60)] + [draw.choice([900, 2500])] * (1 + s % 2 * 4)
        rows += [(1000 * s + i, f"s{s:02}", size) for i, size in enumerate(sizes)]
        rows += [(1000 * s, f"s{s:02}", sizes[0])] * (s % 3)  # repeated rows are taken together
    return rows


def test_mix_comes_near_beside_long_documents(spark):
    rows = spark.createDataFrame(long_and_short(), "doc_id bigint, source string, size int")
    got = mixing.mix_table(rows.select("doc_id", "source", F.repeat(F.lit("w "), "size").alias("text")))
    off = got.join(rows.select("doc_id", "source").distinct(), "doc_id").groupBy("source", "target").agg(F.sum("taken").alias("words"))
    far = {r.source: r.words - r.target for r in off.collect() if abs(r.words - r.target) > 100}
    assert far == {}


def test_mix_takes_in_order_what_fits(spark):
    rows = long_and_short()
    slim = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    plan, refused = mixing.plan_of(slim)
    drawn = mixing.with_draw(slim, plan.select("source", "source_size", "missing"), 0).collect()
    taken = {(r.source, r.doc_id): r.copies - r.whole for r in mixing.copies(slim.withColumn("w", F.lit(0)), plan, refused).join(plan.select("source", "whole"), "source").collect()}
    for p in plan.collect():
        units = {}
        for r in drawn:
            if r.source == p.source:
                units.setdefault((r.rank, r.doc_id), []).append(r.size)
        rank_of = {i: rank for rank, i in units}
        kept, best, order = {}, None, [(sum(sizes), i) for (_, i), sizes in sorted(units.items())]
        while True:
            open_words, sizes, left, want = p.missing - sum(kept.values()), [], [], set(kept)
            for n, i in [x for x in order if x[1] not in kept]:
                if n <= open_words:
                    open_words -= n
                    sizes += units[rank_of[i], i]
                    want.add(i)
                else:
                    left.append((n, rank_of[i], i))
            if left and min(left)[0] < 2 * open_words:
                n, _, i = left.pop(left.index(min(left)))
                kept[i] = n
                open_words -= n
                want.add(i)
            if best is None or abs(open_words) < abs(best[0]):
                best = open_words, want
            if not sizes or abs(open_words) <= sum(sizes) / len(sizes):
                break
            if open_words > 0:
                kept[min(left)[2]] = min(left)[0]
        assert best[1] == {i for (s, i), n in taken.items() if s == p.source and n}, p.source


def test_mix_repeats_documents(spark):
    rows, docs = mix_docs(spark)
    want = {}
    for r in mixing.mix_table(docs.filter("doc_id <> 7")).collect():
        if r.taken:
            want[r.doc_id] = r.taken // r.size
    made = mixing.mixed(docs.filter("doc_id <> 7"))
    assert made.columns == docs.columns
    got = {}
    for r in made.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want


def test_mix_of_nothing(spark):
    _, docs = mix_docs(spark)
    assert mixing.mix_table(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix_table(docs.filter("text IS NULL")).collect()] == [0]


# --- nearest neighbours -----------------------------------------------------------------


def brute_neighbours(vectors, k):
    out = {}
    for q, v in vectors.items():
        if q % 20 == 0:
            scored = sorted((-sum(float(a) * float(b) for a, b in zip(v, w, strict=True)), i) for i, w in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vector_rows(seed, count, copies):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, 12))
    rows = {i: (centres[i % 6] + 0.4 * draw.standard_normal(12)).astype(np.float32).tolist() for i in range(count)}
    for i in range(copies):
        rows[count + i] = rows[3]
    return rows


def test_neighbours_are_found(spark):
    vectors = vector_rows(1, 1500, 70)
    odd = [(9000, None), (9020, []), (9040, [0.0] * 12), (9060, [1.0] * 11 + [None]), (9080, [float("nan")] * 12), (9100, [1.0, 2.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame([*vectors.items(), *odd, (3, vectors[3])], "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS score", "'x' AS v")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute_neighbours(vectors, 20)
    assert set(got) == set(want)
    hit = 0
    for q, listed in want.items():
        assert sorted(got[q]) == list(range(1, 21))
        found = [got[q][i] for i in range(1, 21)]
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        exact = {i: sum(float(a) * float(b) for a, b in zip(vectors[q], vectors[i], strict=True)) for i, _ in found}
        assert all(s == pytest.approx(exact[i], rel=1e-12) for i, s in found)
        hit += len({i for i, _ in found} & {i for i, _ in listed})
    assert hit >= 0.9 * 20 * len(want)


def test_few_and_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 1.0])], schema)
    got = neighbours.search(few, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 3.0), (0, 2, 1, 1.0)]
    none = spark.createDataFrame([], schema)
    assert neighbours.search(none, F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square_quantiles():
    # Published values of the distribution.
    for p, freedom, value in ((0.95, 10, 18.307), (0.5, 6, 5.348), (0.99, 1, 6.635)):
        assert neighbours.chi_square_quantile(p, freedom) == pytest.approx(value, abs=1e-3)



def stored_vectors(spark, tmp_path, vectors):
    import pyarrow as pa
    import pyarrow.parquet as pq

    flat = pa.array(np.ascontiguousarray(vectors, np.float64).ravel())
    lists = pa.FixedSizeListArray.from_arrays(flat, vectors.shape[1]).cast(pa.list_(pa.float64()))
    pq.write_table(pa.table({"vec_id": np.arange(len(vectors)), "embedding": lists}), tmp_path / "v.parquet")
    return spark.read.parquet(str(tmp_path / "v.parquet"))


def test_ties_go_to_smaller_numbers(spark, tmp_path):
    """399 different vectors with a product of exactly 0.5, the other half free."""
    draw = np.random.default_rng(3)
    vectors = draw.standard_normal((8000, 16))
    vectors /= 4 * np.linalg.norm(vectors, axis=1)[:, None]
    vectors[0] = np.eye(16)[0]
    equal = np.arange(27, 8000, 20)[:399]
    vectors[equal, 0] = 0.5
    got = neighbours.search(stored_vectors(spark, tmp_path, vectors), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == equal[:20].tolist()
    assert {r.score for r in got} == {0.5}


def test_leaves_are_left_out_and_neighbours_are_not(spark, tmp_path):
    """100,000 vectors in 1,000 clusters: at most a third of the leaves read, recall 0.9 or more."""
    draw = np.random.default_rng(0)
    centres = draw.standard_normal((1000, 64))
    vectors = centres[draw.integers(0, 1000, 100_000)] + 0.3 * draw.standard_normal((100_000, 64))
    seen = {}
    hits = neighbours.search(stored_vectors(spark, tmp_path, vectors), F.col("vec_id") % 1000 == 0, statistics=seen).collect()
    found = {}
    for r in hits:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    right = 0
    for q in range(0, 100_000, 1000):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        right += len(found[q] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    share = seen["read"] / (seen["leaves"] * seen["queries"])
    assert seen["leaves"] > 1000 and share <= 1 / 3, share
    assert right / 2000 >= 0.9, right / 2000
    print(f"leaves read {share:.3f}, recall {right / 2000:.4f}")


# --- archives -------------------------------------------------------------------------------


PAGES = [
    (5, "http://a.example/", "<p>é\r\n\r\n</p>"), (2, "http://b.example/\nx", "<p>é\r\n\r\n</p>"), (9, None, None), (8, "", ""),
    (4, "x", "long " * 30_000), (None, "y", "<p>é\r\n\r\n</p>"), (2, "http://b.example/\nx", "<p>é\r\n\r\n</p>"), (None, "z", "alone"),
]


def test_archives_come_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "1 AS offset", "'f' AS file")
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages, folder, file_bytes=2000)
    assert index.select("file").distinct().count() > 1
    got = warc.read_records(index, folder).collect()
    first = {}
    for page_id, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", page_id)
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        refers = first[html or ""] if first[html or ""] != page_id else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((page_id or 0, len(body), digest, "revisit" if refers is not None else "response", refers, None if refers is not None else body))
    key = lambda r: (r[0], r[1], r[2])
    assert sorted([(r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload) if r.payload is not None else None) for r in got], key=key) == sorted(want, key=key)
    one = warc.read_records(index.filter("page_id = 4"), folder).collect()
    assert len(one) == 1 and bytes(one[0].payload) == b"long " * 30_000
    assert warc.write_archives(pages.limit(0), folder).count() == 0


def test_small_payloads_are_written_whole(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], "page_id bigint, url string, html string")
    index = warc.write_archives(pages, scratch_path(spark, "warc-test"), least_bytes=3)
    assert {r.page_id: r.refers_to for r in index.collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_near_ranges_are_read_together():
    offsets, lengths = np.array([0, 10, 30, 500, 520]), np.array([10, 10, 5, 20, 100])
    assert warc.coalesce_ranges(offsets, lengths, gap=10, most=1000) == [(0, 3), (3, 5)]
    assert warc.coalesce_ranges(offsets, lengths, gap=10, most=25) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert warc.coalesce_ranges(offsets[:0], lengths[:0]) == []


def test_records_are_gzip_members():
    raw = warc.record(1, "u", warc.sha1_base32(b"x"), None, 1, b"x")
    assert gzip.decompress(gzip.compress(raw) * 2) == raw * 2 and raw.endswith(b"\r\n\r\n")


# --- URLs --------------------------------------------------------------------------------------


def brute_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://EXAMPLE.org/es/1?x#y", "http://a.example.org/en/12", "http://notexample.org/es/",
    "http://org", "http://org/", "http://x.com/de/", "http://x.com/fr/a", "http://x.com?de/", "http://x.com#/de/", "http://ÄB.com/de/1", "a://b://c.com/de/",
    "http://x.net/de/5?utm=1&ref=2", "http://xorg/", "http://www.example.org/en/2\n/x",
]


def test_urls_follow_the_longest_rule(spark):
    listed = [*URLS, *[f"http://h{i % 7}.example.com/{('de', 'fr')[i % 2]}/{i}" for i in range(60)], "http://q.net/de/1", "http://q.net/fr/1"]
    pages = spark.createDataFrame(list(enumerate(listed)), "page_id bigint, url string").selectExpr("*", "'h' AS host", "'t' AS tokens")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    assert len(got) == len(listed)
    for i, url in enumerate(listed):
        host, path, rule, verdict = brute_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict in ("allow", "block") and (verdict is None or got[i].verdict == verdict), url
    assert got[len(listed) - 2].verdict == "block" and got[len(listed) - 1].verdict == "allow"


def test_mined_rules_equal_counting(spark):
    draw = random.Random(2)
    rows = []
    for _ in range(300):
        items = sorted({draw.choice("abcdef") for _ in range(3)})
        rows.append((items, "block" if "a" in items and draw.random() < 0.95 or "b" in items and "c" in items else "allow"))
    found = {(tuple(r.needs), r.mined): r for r in urls.mined_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()}
    assert found
    for (needs, mined), r in found.items():
        held = [v for items, v in rows if set(needs) <= set(items)]
        assert r.confidence == pytest.approx(held.count(mined) / len(held)) and r.confidence >= urls.LEAST_CONFIDENCE
        assert r.support == pytest.approx(held.count(mined) / len(rows)) and r.key_token in needs
    # No kept rule is covered by a shorter one that is as sure.
    assert not any(set(a) < set(b) and m == n and found[a, m].confidence >= found[b, n].confidence for a, m in found for b, n in found)


def test_many_shared_tokens_do_not_multiply(spark):
    """One host whose URLs share 20 path words: mined within a minute, and other rules stay."""
    import time

    shared = "/".join(f"word{chr(97 + i)}" for i in range(20))
    listed = [f"http://a.com/de/{shared}/{i}" for i in range(300)] + [f"http://b.com/fr/news/{chr(97 + i % 26)}" for i in range(300)]
    asked = [f"http://x.net/{shared}/9", "http://x.net/wordq", "http://y.net/news/k", "http://z.net/other"]
    rows = spark.createDataFrame(list(enumerate([*listed, *asked])), "page_id bigint, url string")
    start = time.monotonic()
    got = {r.page_id: r.verdict for r in urls.judge_urls(rows, default="none").collect()}
    assert time.monotonic() - start < 60
    assert [got[len(listed) + i] for i in range(4)] == ["block", "block", "allow", "none"]


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None)], "page_id bigint, url string")
    assert [r.verdict for r in urls.judge_urls(pages, default="block").collect()] == ["block"] * 3
    assert urls.judge_urls(pages.limit(0)).count() == 0


# --- dialogues -----------------------------------------------------------------------------------


def brute_dialogues(rows, segment):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        for own in {r for _, r, _ in turns} - {"system"}:
            for s in range(0, len(turns), segment):
                shown, spans = "", []
                for _, role, text in turns[s : s + segment]:
                    text, name = text.replace("<|", "< |"), role.replace("<|", "< |")
                    shown += f"<|im_start|>{'assistant' if role == own else 'system' if role == 'system' else 'user name=' + name}\n"
                    if role == own:
                        spans.append(f"{len(shown)}-{len(shown) + len(text)}")
                    shown += text + "<|im_end|>\n"
                out[conv, own, s // segment] = (shown, " ".join(spans))
    return out


def test_every_speaker_is_once_the_assistant(spark):
    rows = [
        (1, 0, "system", "rules"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "é😀"), (1, 2, "bob", "é😀"), (1, 3, None, None), (1, None, "<|x", ""),
        (2, 0, "system", "alone"), (None, 1, "ann", "a"), (None, 1, "bob", "b"), *[(3, i, "ab"[i % 2], f"t{i}") for i in range(9)],
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS place", "2 AS segment")
    got = dialogue.rotate_perspectives(turns, segment_turns=4).collect()
    assert {(r.conv_id, r.perspective, r.segment): (r.rendered, r.mask) for r in got} == brute_dialogues(rows, 4)
    for r in got:
        spans = [tuple(map(int, x.split("-"))) for x in r.mask.split()]
        assert r.n_masked == sum(b - a for a, b in spans) and r.n_turns <= 4
    assert dialogue.rotate_perspectives(turns.limit(0)).count() == 0


# --- registration and the pipeline ------------------------------------------------------------------


def test_every_operator_has_its_query():
    names = list(queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = [docs]
    for _, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, folder), "stage")
        made.append(docs)
    return made


def test_stages_equal_brute_force(spark, stages):
    from tests.llm.test_texts import brute_components, brute_kept

    docs, clean, single, cut, mix, encoded = stages
    assert clean.columns == single.columns == cut.columns == mix.columns == docs.columns
    everything = {r.doc_id: r for r in docs.collect()}
    left = sorted((r.doc_id, r.text) for r in clean.collect())
    assert all(everything[i].text == t for i, t in left)
    kept = sorted((r.doc_id, r.text) for r in single.collect())
    assert [i for i, _ in kept] == sorted(d for d, _, c in brute_components(left, 5, 80, 100) if d == c)
    text_of = dict(kept)
    after = {r.doc_id: r for r in cut.collect()}
    for i, _, removed, words in brute_kept(kept, 13):
        assert after[i].text == (words if removed else text_of[i])
        assert not removed or after[i].n_chars == len(words)
    taken = {}
    for r in mix.collect():
        assert r.text == after[r.doc_id].text
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert set(taken.values()) <= {1, 2}
    assert encoded.count() == sum(taken.values())
