"""The whole batch over files and extracted tables."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coinsieve.plans.learn import learn_rules
from coinsieve.plans.run import prior_as_txns, run
from coinsieve.plans.summary import summary
from coinsieve.schema import FINAL_COLUMNS
from coinsieve.session import SHUFFLES_CONF, release, shared_dir
from coinsieve.sources.published import current, publish, versions
from coinsieve.sources.sinks import write_deduped
from coinsieve.sources.tables import DEDUPED_COLUMNS, keyword_table, load_prior, rules_table

CELLS = "file string, page int, table_no int, row_no int, cells array<string>, page_text string"


def inputs(tmp_path):
    base = tmp_path / "inputs"
    base.mkdir()
    (base / "chase.csv").write_text(
        "Transaction Date,Description,Amount\n01/05/2024,NETFLIX.COM,12.19\n01/05/2024,netflix.com ONLINE,-12.19\n"
        "01/02/2024,ZELLE Rent,850\n01/09/2024,something odd,3\nbad,no date,1\n"
    )
    (base / "AccountHistory.csv").write_text("Post Date,Description,Debit,Credit\n01/03/2024,ATM Withdrawal,60,\n")
    (base / "broken.csv").write_text("a,b\n1,2\n")
    return str(base)


def tables(spark):
    rows = [
        ("scan.pdf", 1, None, None, None, "Citi statement"),
        ("scan.pdf", 2, 1, 0, ["Date", "x", "y", "z"], ""), ("scan.pdf", 2, 1, 1, ["1", "2", "3", "4"], ""),
        ("scan.pdf", 2, 2, 0, ["01/01/2024", "01/04/2024", "UBER *EATS 800", "$1,041.91"], ""),
        ("scan.pdf", 2, 2, 1, ["01/06/2024", "LATE FEE"], ""),
    ]
    return spark.createDataFrame(rows, CELLS)


def test_run_over_files_and_tables(spark, tmp_path):
    rules = rules_table(spark, [("zelle ", None, [1, 5], "Rent")])
    keywords = keyword_table(spark, {"Entertainment": ["netflix"], "Food": ["uber *eats"], "Payments": ["withdrawal"], "Fees": ["fee"]})
    out = str(tmp_path / "out")
    combined, kept, rejected = run(spark, inputs(tmp_path), out, rules, keywords, cells=tables(spark), matcher="edit")
    got = {r.description: (r.source, r.category, r.amount) for r in combined.collect()}
    assert got == {
        "NETFLIX.COM": ("Chase", "Entertainment", 12.19), "netflix.com ONLINE": ("Chase", "Entertainment", -12.19),
        "ZELLE Rent": ("Chase", "Rent", 850.0), "something odd": ("Chase", "Uncategorized", 3.0),
        "no date": ("Chase", "Uncategorized", 1.0), "ATM Withdrawal": ("SFCU", "Payments", 60.0),
        "UBER *EATS 800": ("Citi", "Food", 1041.91), "LATE FEE": ("Citi", "Fees", 0.47),
    }
    assert {r.description for r in kept.collect()} == set(got) - {"netflix.com ONLINE"}
    assert [r.file.split("/")[-1] for r in rejected.collect()] == ["broken.csv"]

    report = load_prior(spark, f"{out}/deduplicated", DEDUPED_COLUMNS)
    assert report.columns == FINAL_COLUMNS and report.count() == 7
    metrics = {(r.section, r.metric): r.value for r in summary(combined, kept).collect()}
    assert metrics[("transactions", "removed")] == 1 and metrics[("categories", "Uncategorized.n")] == 2

    # A second run trusts the report: nothing is matched again, results stay.
    prior = prior_as_txns(load_prior(spark, f"{out}/deduplicated"))
    again, _, _ = run(spark, str(tmp_path / "inputs"), str(tmp_path / "out2"), prior=prior)
    done = {r.description: r.category for r in again.filter("category <> 'Uncategorized'").collect()}
    assert done == {"NETFLIX.COM": "Entertainment", "ZELLE Rent": "Rent", "ATM Withdrawal": "Payments"}
    assert learn_rules(combined, rules).count() >= 1


def test_run_with_functions(spark, tmp_path):
    def normalizer(texts):
        return "\n".join(t.split(" ")[0].title() for t in texts)

    def judge(frame):
        return [json.dumps({"is_duplicate": False, "reasoning": "no"}) for _ in range(len(frame))]

    combined, kept, _ = run(
        spark, inputs(tmp_path), str(tmp_path / "out"), normalizer=normalizer, judge=judge, attempts=1, wait=(0.0, 0.0)
    )
    assert {r.normalized_desc for r in combined.collect()} == {"Netflix.Com", "Zelle", "Something", "No", "Atm"}
    assert kept.count() == combined.count() == 6


def test_a_second_run_asks_for_new_texts_only(spark, tmp_path):
    """The caches keep what was normalized and categorized, version by version."""
    from coinsieve.schema import CATEGORIZE_CACHE, NORMALIZE_CACHE
    from coinsieve.sources.tables import latest_cache

    keywords = keyword_table(spark, {"Entertainment": ["netflix"]})
    folder, caches = inputs(tmp_path), str(tmp_path / "caches")

    def first(texts):
        return "\n".join(t.lower() for t in texts)

    def second(texts):
        return "\n".join("asked again" for _ in texts)

    options = {"keywords": keywords, "matcher": "edit", "caches": caches, "attempts": 1, "wait": (0.0, 0.0)}
    once, _, _ = run(spark, folder, str(tmp_path / "1"), normalizer=first, **options)
    again, _, _ = run(spark, folder, str(tmp_path / "2"), normalizer=second, **options)
    shown = ["description", "normalized_desc", "category", "confidence"]
    assert sorted(once.select(*shown).collect(), key=str) == sorted(again.select(*shown).collect(), key=str)
    for name, schema in (("normalize", NORMALIZE_CACHE), ("categorize", CATEGORIZE_CACHE)):
        entries = latest_cache(spark, f"{caches}/{name}", schema)
        assert versions(spark, f"{caches}/{name}") == ([1, 2], [])
        assert entries.count() == entries.select("key").distinct().count() > 0
    assert latest_cache(spark, f"{caches}/none", NORMALIZE_CACHE).count() == 0


# --- what a run leaves on disk ---------------------------------------------------------


def test_a_run_leaves_no_copies_of_its_rows(spark, tmp_path):
    """Two runs through the caches: of the rows one copy is left by each, reports are packed, and the
    setting for shuffle files is as it was."""
    base, caches = tmp_path / "inputs", str(tmp_path / "caches")
    base.mkdir()
    lines = "".join(f"01/{i % 28 + 1:02}/2024,Shop {i % 7},{i}.25\n" for i in range(20_000))
    (base / "chase.csv").write_text(f"Transaction Date,Description,Amount\n{lines}")
    folder = Path(shared_dir(spark).removeprefix("file:"))

    def sizes():
        found = {}
        for part in folder.glob("*/rdd-*/part-*"):
            found[part.parent] = found.get(part.parent, 0) + part.stat().st_size
        return found

    options = {"keywords": keyword_table(spark, {"Odd": ["3", "5"]}), "matcher": "edit", "caches": caches}
    before, setting = set(sizes()), spark.conf.get(SHUFFLES_CONF)
    once, kept, _ = run(spark, str(base), str(tmp_path / "1"), normalizer=lambda t: "\n".join(t).lower(), **options)
    again, _, _ = run(spark, str(base), str(tmp_path / "2"), normalizer=lambda t: "\n".join("x" for _ in t), **options)
    assert spark.conf.get(SHUFFLES_CONF) == setting
    large = {place: size for place, size in sizes().items() if place not in before and size > 100_000}
    assert len(large) == 2
    for out in ("1", "2"):
        for report in ("combined", "deduplicated"):
            parts = list((tmp_path / out / report).glob("version=1/part-*"))
            assert sum(p.stat().st_size for p in parts) < 30 * 20_000
            assert load_prior(spark, str(tmp_path / out / report), ["category"] if report == "combined" else None).count() == 20_000
    # Rows that are handed on can be read as often as one likes.
    assert kept.count() == 20_000 and len(kept.collect()) == len(kept.collect()) == 20_000
    assert again.exceptAll(once).isEmpty() and once.filter("category = 'Odd'").count() > 0
    release(once)
    assert len({p for p in sizes() if p in large}) == 1
    assert again.filter("normalized_desc LIKE 'shop _'").count() == 20_000


# --- published results ---------------------------------------------------------------


def failing(df):
    """Rows of which one fails after others have been written."""
    return df.repartition(1).withColumn("description", F.when(F.col("seq") == 9_000, F.raise_error(F.lit("half-way"))).otherwise(F.col("description")))


def test_a_writer_that_fails_half_way_leaves_the_earlier_result(spark, txns, tmp_path):
    out = str(tmp_path / "report")
    extra = {"category": F.lit("Food"), "confidence": F.lit(1.0), "reasoning": F.lit("r"), "is_duplicate": F.lit(False), "dedupe_reasoning": F.lit("")}
    rows = txns([(f"t{i}", 1.0, "2024-01-01") for i in range(10_000)]).withColumns(extra)
    write_deduped(rows.filter("seq < 3"), out)
    with pytest.raises(Exception, match="half-way"):
        write_deduped(failing(rows), out)
    assert versions(spark, out) == ([1], [2])
    assert load_prior(spark, out).count() == 3
    write_deduped(rows.filter("seq < 5"), out)
    assert versions(spark, out) == ([1, 3], []) and load_prior(spark, out).count() == 5


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        publish(spark, path, spark.range(n).write.parquet, kept=2)
    assert versions(spark, path) == ([4, 5], [])
    assert spark.read.parquet(current(spark, path)).count() == 5


# --- runs over files that were scanned before -------------------------------------------


def test_a_second_run_reads_no_old_file(spark, tmp_path):
    folder, store = inputs(tmp_path), str(tmp_path / "store")
    base = tmp_path / "inputs"
    (base / "amex [1] 100%.csv").write_text('Date,Description,Amount\n01/08/2024,"odd\nname",7\n')
    (base / "amex.csv").write_text("")

    def result(n):
        rows, _, rejected = run(spark, folder, str(tmp_path / f"out{n}"), store=store)
        return sorted((r.description, r.amount) for r in rows.collect()), sorted(r.file.split("/")[-1] for r in rejected.collect())

    plain, _, refused = run(spark, folder, str(tmp_path / "plain"))
    want = sorted((r.description, r.amount) for r in plain.collect())
    bad = sorted(r.file.split("/")[-1] for r in refused.collect())
    assert result(1) == (want, bad) and ("odd\nname", 7.0) in want and bad == ["amex.csv", "broken.csv"]
    # Other bytes with the same length and time: whoever reads the file again would see them.
    for path in base.iterdir():
        state, text = path.stat(), path.read_text()
        path.write_text(text.replace("ATM", "XXX").replace("NETFLIX", "XXXXXXX").replace("odd", "XXX"))
        os.utime(path, ns=(state.st_atime_ns, state.st_mtime_ns))
    assert result(2) == (want, bad)
    # A new file is read, a changed one read anew, a removed one forgotten.
    (base / "chase new.csv").write_text("Transaction Date,Description,Amount\n01/05/2024,new,1\n")
    (base / "AccountHistory.csv").write_text("Post Date,Description,Debit,Credit\n01/03/2024,changed,60,\n01/03/2024,more,1,\n")
    (base / "amex [1] 100%.csv").unlink()
    (base / "amex.csv").write_text("Date,Description,Amount\n01/05/2024,filled,2\n")
    got, bad = result(3)
    assert bad == ["broken.csv"]
    assert got == sorted([w for w in want if w[0] not in ("ATM Withdrawal", "odd\nname")] + [("changed", 60.0), ("more", 1.0), ("new", 1.0), ("filled", 2.0)])
    assert len(list((tmp_path / "store" / "rows").glob("scan=*"))) == 2
