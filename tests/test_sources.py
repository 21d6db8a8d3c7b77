"""Files in: layouts, scans, extracted tables, rules, caches, logs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from coinsieve.schema import NORMALIZE_CACHE
from coinsieve.sources import cells as ce
from coinsieve.sources.layouts import infer_layout
from coinsieve.sources.sinks import write_rules
from coinsieve.sources.statements import read_inferred, read_layout, scan_statements, typed
from coinsieve.sources.tables import (
    builtin_keywords, load_cache, load_prior, load_rules, read_log, rules_table, starter_rules,
)
from coinsieve.operators.rows import filter_log, tail_log

FILES = {
    "boa.csv": "Payee,Extra,Posted Date,Amount\nSHOP,x,01/05/2024,\"1,234.50\"\nBAD,x,nope,3\n",
    "AccountHistory.csv": "Post Date,Description,Debit,Credit\n01/05/2024,A,5.00,\n01/06/2024,B,,7.00\n01/07/2024,C,,\n",
    "citi.csv": "Posted Date,Payee,Amount\n01/05/2024,CITI SHOP,-2\n",
    "chase_1.csv": "Transaction Date,Post Date,Description,Amount\n01/05/2024,01/06/2024,\"A, \"\"B\"\" C\",9.99\n",
    "amex.CSV": "Date,Description,Amount\r\n01/05/2024,AMEX SHOP,1\r\n",
    "Discover.csv": "﻿Trans. Date,Description,Amount\n01/05/2024,D SHOP,1.5\n",
    "capital_one.csv": "Transaction Date,Description,Debit,Credit\n01/05/2024,X,4,\n01/06/2024,Y,,6\n",
    "unknown.csv": "Booking Date,Narration,Credit,Debit,Amount\n2024-01-05,U,1,2,3\n",
    "split.csv": "Posted,Payee Name,Debit amt,Credit x\n2024-01-05,V,2,\n",
    "net.csv": "Posted,Payee Name,Debit,Credit\n2024-01-05,N,2,\n2024-01-05,M,,8\n",
    "nodesc.csv": "Date,Amount\n2024-01-05,3\n",
    "citi_broken.csv": "Date,Text,Amount\n01/05/2024,q,1\n",
    "empty_rows.csv": "Date,Description,Amount\n\n   \n2024-02-01,E,1\n",
    "notes.txt": "Date,Description,Amount\n2024-02-01,NO,1\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    for name, body in FILES.items():
        (base / name).write_bytes(body.encode())
    return str(base)


@pytest.fixture(scope="module")
def scanned(spark, folder):
    rows, rejected = scan_statements(spark, folder)
    got = [
        (r.source, r.description, r.amount, r.date)
        for r in typed(rows).collect()
    ]
    return got, {r.file.split("/")[-1]: r.problem for r in rejected.collect()}


DAY = dt.date(2024, 1, 5)


@pytest.mark.parametrize("row", [
    ("BoA", "SHOP", 1234.5, DAY), ("BoA", "BAD", 3.0, None),
    ("SFCU", "A", 5.0, DAY), ("SFCU", "B", -7.0, dt.date(2024, 1, 6)), ("SFCU", "C", 0.0, dt.date(2024, 1, 7)),
    ("Citi", "CITI SHOP", -2.0, DAY), ("Chase", 'A, "B" C', 9.99, DAY), ("AMEX", "AMEX SHOP", 1.0, DAY),
    ("Discover", "D SHOP", 1.5, DAY), ("Capital One", "X", 4.0, DAY), ("Capital One", "Y", None, dt.date(2024, 1, 6)),
    ("Unknown", "U", 1.0, DAY), ("Unknown", "N", -2.0, DAY), ("Unknown", "M", 8.0, DAY), ("Unknown", "E", 1.0, dt.date(2024, 2, 1)),
])
def test_scan_gives_row(scanned, row):
    if row[1] == "U":  # an amount column next to debit and credit: the first amount-like one counts
        assert row in scanned[0]
    else:
        assert scanned[0].count(row) == 1


def test_scan_gives_nothing_else(scanned):
    assert len(scanned[0]) == 16  # the rows above and the one of split.csv


def test_bad_files_are_reported(scanned):
    assert scanned[1] == {
        "nodesc.csv": "missing column: ?", "citi_broken.csv": "missing column: Posted Date, Payee",
    }


def test_scan_can_fail_on_a_bad_file(spark, folder):
    with pytest.raises(ValueError, match="missing column"):
        scan_statements(spark, folder, on_error="fail")


def test_lines_and_headers_of_odd_width(spark, tmp_path):
    (tmp_path / "amex.csv").write_text("Date,Description,Amount\n01/05/2024,long,1,extra,cells\n01/05/2024,short\n")
    wide = ",".join(f"c{i}" for i in range(70))
    (tmp_path / "wide.csv").write_text(f"Date,Description,Amount,{wide}\n01/05/2024,w,1\n")
    rows, rejected = scan_statements(spark, str(tmp_path))
    assert sorted((r.description, r.amount) for r in rows.collect()) == [("long", 1.0), ("short", None), ("w", 1.0)]
    assert rejected.count() == 0


def test_names_of_files_decide_alone(spark, tmp_path):
    (tmp_path / "boa_files").mkdir()
    (tmp_path / "boa_files" / "part-2024-chase.csv").write_text("Transaction Date,Description,Amount\n01/05/2024,c,1\n")
    (tmp_path / "amex 100%.csv").write_text("Date,Description,Amount\n01/05/2024,a,1\n")
    (tmp_path / "amex.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n")
    rows, rejected = scan_statements(spark, str(tmp_path))
    assert sorted((r.source, r.description) for r in rows.collect()) == [("AMEX", "a"), ("Chase", "c")]
    assert sorted(r.file.split("/")[-1] for r in rejected.collect()) == ["amex.csv", "blank.csv"]


TRICKY = 'Date,Description,Amount\n01/05/2024,"JOE ""S"" PIZZA, NY",12.50\n01/06/2024,"TWO\n\nLINES",7.00\n01/07/2024,plain,1\n'
TRICKY_ROWS = [('JOE "S" PIZZA, NY', 12.5), ("TWO\n\nLINES", 7.0), ("plain", 1.0)]


def test_all_readers_agree_on_quoted_cells(spark, tmp_path):
    import io

    import pandas as pd

    want = pd.read_csv(io.StringIO(TRICKY))
    assert list(zip(want.Description, want.Amount, strict=True)) == TRICKY_ROWS
    (tmp_path / "in").mkdir()
    for name in ("amex.csv", "amex 2.csv"):
        (tmp_path / "in" / name).write_text(TRICKY)
    (tmp_path / "in" / "amex plain.csv").write_text("Date,Description,Amount\n01/05/2024,x,1\n")
    (tmp_path / "in" / "amex open.csv").write_text('Date,Description,Amount\n01/05/2024,"x,1\n')
    both = sorted([*TRICKY_ROWS * 2, ("x", 1.0)])
    rows, rejected = scan_statements(spark, str(tmp_path / "in"))
    assert sorted((r.description, r.amount) for r in rows.collect()) == both
    assert [r.problem for r in rejected.collect()] == ["a quoted cell has no end"]
    paths = [str(tmp_path / "in" / n) for n in ("amex.csv", "amex 2.csv")]
    for path in paths:
        for read in (lambda p: read_layout(spark, p, "amex"), lambda p: read_inferred(spark, p)):
            assert sorted((r.description, r.amount) for r in read(path).collect()) == sorted(TRICKY_ROWS)


def test_a_block_is_stitched_by_many_tasks(spark, tmp_path, monkeypatch):
    """Cells over line ends, also over whole stretches, in one file of one block."""
    from coinsieve.sources import statements

    monkeypatch.setattr(statements, "STRETCH_BITS", 2)
    monkeypatch.setattr(statements, "LINES_PER_TASK", 40)
    held = []

    def kept(df, materialize=statements.materialize):
        out = materialize(df)
        if "in1" in out.columns:
            held.extend(r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
        return out

    monkeypatch.setattr(statements, "materialize", kept)
    want = [(f'n{i} "a", b' + "\n" * (i % 13), float(i)) for i in range(60)]
    rows = "".join('01/05/2024,"' + text.replace('"', '""') + f'",{amount}\n' for text, amount in want)
    (tmp_path / "amex.csv").write_text("Date,Description,Amount\n" + rows)
    got = read_layout(spark, str(tmp_path / "amex.csv"), "amex").collect()
    assert sorted((r.description, r.amount) for r in got) == sorted(want)
    assert sum(held) == 1 + sum(1 + i % 13 for i in range(60)) and max(held) < sum(held) / 4


def test_a_scan_parses_only_named_cells(spark, tmp_path, capsys):
    """A place that one file names may hold anything in the others."""
    wide = ",".join(f"x{i}" for i in range(20))
    (tmp_path / "amex.csv").write_text(f"{wide},Date,Description,Amount\n{','.join('9' * 20)},01/05/2024,a,1\n")
    (tmp_path / "amex 2.csv").write_text("\ufeffAmount,Date,Other,Description\r\n2,01/06/2024,o,b\r\n")
    (tmp_path / "sfcu.csv").write_text('Debit,Credit,Post Date,Description\n,3,01/07/2024,"c, ""d"""\n4\n')
    (tmp_path / "sfcu 2.csv").write_text('Post Date,Description,x,Debit,Credit\n01/08/2024,"two\nlines",,5,\n')
    rows, rejected = scan_statements(spark, str(tmp_path))
    rows.explain()
    read = capsys.readouterr().out
    assert "c20" in read and not any(f"c{i}:string" in read for i in range(5, 20))
    got = [(r.raw_date, r.description, r.amount) for r in rows.collect()]
    assert sorted(got, key=str) == sorted([
        ("01/05/2024", "a", 1.0), ("01/06/2024", "b", 2.0), ("01/07/2024", 'c, "d"', -3.0), (None, None, 4.0), ("01/08/2024", "two\nlines", 5.0),
    ], key=str)
    assert rejected.count() == 0


def test_inch_marks_keep_their_rows(spark, tmp_path):
    import csv

    head = "Date,Description,Amount\n"
    plain = "".join(f"01/05/2024,p{i},{i}\n" for i in range(5))
    tv, cell = '01/06/2024,24" TV,1\n', '01/07/2024,"A ""B"", x\n\n12"" y",2\n'
    bodies = {
        "amex one.csv": head + plain + tv + plain, "amex two.csv": head + tv + plain + tv + plain,
        "amex both.csv": head + tv + cell + plain + '"01/06/2024","x"y" TV,3\n' + cell + tv,
    }
    want = []
    for name, body in bodies.items():
        (tmp_path / name).write_text(body)
        want += [(r["Description"], float(r["Amount"])) for r in csv.DictReader(body.splitlines(keepends=True))]
    rows, rejected = scan_statements(spark, str(tmp_path))
    got = [(r.description, r.amount) for r in rows.collect()]
    # Of a cell that goes on after its closing quote only the place is compared.
    assert sorted(g for g in got if g[1] != 3) == sorted(w for w in want if w[1] != 3) and len(got) == len(want)
    assert rejected.count() == 0


def test_records_are_found_over_blocks(spark, tmp_path):
    import csv
    import random

    draw = random.Random(5)
    texts = ["plain", '24" TV', "two\nlines", 'a "b"\n\n"c", d', "x," * 9, '5" and\n6"', 'say ""', "\n,\n"]
    rows = [(draw.choice(texts) + str(i), i) for i in range(1, 400)]
    for name in ("amex.csv", "amex 2.csv"):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["Date", "Description", "Amount"])
            for text, n in rows:  # inch marks without quotes round the cell, as banks write them
                f.write(f"01/05/2024,{text},{n}\n") if "," not in text and "\n" not in text else out.writerow(["01/05/2024", text, n])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        got, rejected = scan_statements(spark, str(tmp_path))
        assert sorted((r.description, r.amount) for r in got.collect()) == sorted(rows * 2)
        assert got.select("block").distinct().count() > 20 and rejected.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def broken_file(path, n):
    """A file of n rows, each third with a line break inside a cell."""
    texts = [f"two\nlines {i}" if i % 3 == 0 else f"plain {i}" for i in range(n)]
    path.write_text("Date,Description,Amount\n" + "".join(f'01/05/2024,"{t}",{i}\n' for i, t in enumerate(texts)))
    return sorted((t, float(i)) for i, t in enumerate(texts))


def test_line_breaks_do_not_make_a_file_one_task(spark, tmp_path, small_blocks):
    want = broken_file(tmp_path / "amex.csv", 400)
    blocks = (tmp_path / "amex.csv").stat().st_size // 1000
    assert blocks >= 10
    rows = read_layout(spark, str(tmp_path), "amex")
    assert sorted((r.description, r.amount) for r in rows.collect()) == want
    assert rows.rdd.getNumPartitions() >= 10


def test_a_stream_reads_a_broken_file_by_block(spark, tmp_path, small_blocks):
    from coinsieve.streaming.ingest import statement_stream

    (tmp_path / "in").mkdir()
    want = broken_file(tmp_path / "in" / "amex.csv", 400)
    stream = statement_stream(spark, str(tmp_path / "in"), "amex", ["Date", "Description", "Amount"])
    rows = stream.read(spark.createDataFrame([(str(tmp_path / "in" / "amex.csv"),)], "path string"))
    assert sorted((r.description, r.amount) for r in rows.collect()) == want
    assert rows.rdd.getNumPartitions() >= 10


def test_a_broken_file_with_another_header_fails(spark, tmp_path):
    (tmp_path / "1.csv").write_text("Date,Description,Amount\n01/05/2024,x,1\n")
    (tmp_path / "2.csv").write_text('Date,Amount,Description\n01/05/2024,1,"a\nb"\n')
    with pytest.raises(ValueError, match="another header"):
        read_layout(spark, str(tmp_path), "amex", columns=["Date", "Description", "Amount"])


def test_the_scan_reads_once_and_copies_no_lines(spark, tmp_path):
    (tmp_path / "amex.csv").write_text("Date,Description,Amount\n01/05/2024,a,1\n")
    rows, _ = scan_statements(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
    # One row per file is joined; no lines come from a checkpoint.
    assert all("value" not in line for line in plan.splitlines() if "ExistingRDD" in line)


def test_rows_are_numbered_in_the_order_of_their_files(spark, tmp_path, small_blocks):
    from coinsieve.plans.run import in_file_order
    from coinsieve.sources.statements import csv_files

    for name in ("b amex.csv", "a amex.csv", "c chase.csv"):
        head = "Transaction Date,Description,Amount" if "chase" in name else "Date,Description,Amount"
        (tmp_path / name).write_text(head + "\n" + "".join(f"01/05/2024,{name[0]}{i:05},{i}\n" for i in range(500)))
    broken_file(tmp_path / "d amex.csv", 300)
    rows, _ = scan_statements(spark, str(tmp_path))
    got = in_file_order(rows, csv_files(spark, str(tmp_path))).collect()
    assert len({r.seq for r in got}) == len(got) == 1800
    got.sort(key=lambda r: r.seq)
    assert [r.description for r in got[:1500]] == [f"{c}{i:05}" for c in "abc" for i in range(500)]
    assert [r.amount for r in got[1500:]] == list(range(300))


def test_a_file_that_fails_part_way_is_rejected(spark, tmp_path):
    import struct
    import zlib

    head = "Date,Description,Amount\n"
    body = (head + "".join(f"01/05/2024,row {i},1\n" for i in range(30_000))).encode()
    sums = [zlib.crc32(body[i:i + 512]) for i in range(0, len(body), 512)]
    sums[-1] ^= 1
    (tmp_path / "amex [1] 100%.csv").write_bytes(body)
    (tmp_path / ".amex [1] 100%.csv.crc").write_bytes(b"crc\0" + struct.pack(f">i{len(sums)}I", 512, *sums))
    for i in range(3):
        (tmp_path / f"amex {i}.csv").write_text(head + f"01/05/2024,good {i},1\n")
    rows, rejected = scan_statements(spark, str(tmp_path))
    assert sorted(r.description for r in rows.collect()) == ["good 0", "good 1", "good 2"]
    (bad,) = rejected.collect()
    assert "amex" in bad.file and "good" not in bad.file and bad.problem == "empty or unreadable file"
    with pytest.raises(ValueError, match="unreadable"):
        scan_statements(spark, str(tmp_path), on_error="fail")


def test_a_fault_that_passes_loses_nothing(spark, tmp_path, monkeypatch):
    from py4j.protocol import Py4JError

    from coinsieve.sources import statements

    (tmp_path / "amex.csv").write_text("Date,Description,Amount\n01/05/2024,a,1\n")
    turns = []

    def once(df, kept=statements.materialize):
        turns.append(df)
        if len(turns) == 1:
            raise Py4JError("a passing fault")
        return kept(df)

    monkeypatch.setattr(statements, "materialize", once)
    rows, rejected = scan_statements(spark, str(tmp_path))
    assert [r.description for r in rows.collect()] == ["a"] and rejected.count() == 0


def test_a_stream_reads_quoted_cells(spark, tmp_path):
    from coinsieve.streaming.ingest import ingest_stream, statement_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "amex.csv").write_text(TRICKY)
    rows = statement_stream(spark, str(tmp_path / "in"), "amex", ["Date", "Description", "Amount"])
    ingest_stream(rows, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.description, r.amount) for r in got) == sorted(TRICKY_ROWS)


def test_empty_names_in_a_header_keep_their_place(spark, tmp_path):
    (tmp_path / "amex.csv").write_text("Date,,Description,Amount\n01/05/2024,x,shop,1\n")
    rows, _ = scan_statements(spark, str(tmp_path))
    assert [(r.description, r.amount) for r in rows.collect()] == [("shop", 1.0)]


def test_read_layout_picks_by_name(spark, folder):
    rows = typed(read_layout(spark, f"{folder}/boa.csv", "boa"))
    assert {(r.description, r.amount, r.source) for r in rows.collect()} == {("SHOP", 1234.5, "BoA"), ("BAD", 3.0, "BoA")}
    assert "boa.csv" in rows.first().file


def test_capital_one_credits_on_request(spark, folder):
    rows = read_layout(spark, f"{folder}/capital_one.csv", "capital_one", net_credit=True)
    assert {r.description: r.amount for r in rows.collect()} == {"X": 4.0, "Y": -6.0}


def test_infer_layout():
    assert infer_layout(["When posted", "Payee", "Amount"]).date == "When posted"
    assert infer_layout(["Date", "Amount"]) is None
    both = infer_layout(["Date", "Desc", "Debit", "Credit"])
    assert (both.debit, both.credit, both.sign, both.amount) == ("Debit", "Credit", "credit", None)
    assert infer_layout(["Date", "Desc", "Debit"]).amount == "Debit"


def test_read_inferred_of_an_unfit_file_is_empty(spark, folder):
    assert read_inferred(spark, f"{folder}/nodesc.csv").count() == 0


# --- extracted tables -----------------------------------------------------------------

CELLS = "file string, page int, table_no int, row_no int, cells array<string>, page_text string"


def shaped(spark, source, *rows):
    df = spark.createDataFrame([("f", 1, 1, i, list(r), "") for i, r in enumerate(rows)], CELLS)
    got = ce.shape_rows(df, source).orderBy("row_no").collect()
    return [(r.raw_date, r.description, r.raw_amount) for r in got]


def test_apple_rows(spark):
    assert shaped(
        spark, "Apple", ["$01/02/2024", "ACH Deposit x", "-$1,000.00"], ["d", "Shop", "2%", "$5.00"], ["d", "Shop", "2%", ""],
        ["d", "Shop", "2%", None], ["d", "Shop", "$5"],
    ) == [("01/02/2024", "ACH Deposit x", "-1000.00"), ("d", "Shop", "5.00")]


def test_boa_rows(spark):
    assert shaped(spark, "BoA", ["a", "d", "Shop", "r", "n", "$1,000.5", "more"], ["a", "", "Shop", "r", "n", "$1"], ["a", "d", "Shop"]) == [
        ("d", "Shop", "1000.5")
    ]


def test_citi_rows(spark):
    assert shaped(spark, "Citi", ["t", "p", "Shop", "-$3"], ["t", "", "Shop", "$3"], ["t", None, "Shop", "$4"], ["t", "LATE FEE"], ["t", "x"], ["t", "p", "", "$3"]) == [
        ("p", "Shop", "-3"), ("t", "Shop", "3"), ("t", "Shop", "4"), ("t", "LATE FEE", "0.47")
    ]


def test_sources_without_layout_give_no_rows(spark):
    assert shaped(spark, "SFCU", ["a", "b", "c", "d", "e", "f"]) == []


def test_header_tables_are_dropped_whole(spark):
    df = spark.createDataFrame(
        [("f", 1, 1, 0, ["Date", "x"], ""), ("f", 1, 1, 1, ["1", "x"], ""), ("f", 1, 2, 0, ["1", "y"], ""),
         ("f", 1, 3, 0, ["", "z"], ""), ("f", 2, 1, 1, ["Date", "w"], ""), ("f", 2, 1, 0, [None, "w"], "")], CELLS)
    assert sorted((r.page, r.table_no, r.row_no) for r in ce.drop_header_tables(df).collect()) == [(1, 2, 0), (2, 1, 0), (2, 1, 1)]


def test_bank_found_on_a_page_holds_for_later_pages(spark):
    pages = [("x/scan.pdf", 1, ""), ("x/scan.pdf", 2, "Bank of America and Citi"), ("x/scan.pdf", 3, "Bank of America"),
             ("x/Apple Card.pdf", 1, "Citi"), ("x/eStmt.pdf", 1, "")]
    df = spark.createDataFrame(pages, "file string, page int, page_text string")
    assert {(r.file, r.page): r.source for r in ce.identify_source_text(df).collect()} == {
        ("x/scan.pdf", 1): "Unknown", ("x/scan.pdf", 2): "Citi", ("x/scan.pdf", 3): "Citi",
        ("x/Apple Card.pdf", 1): "Apple", ("x/eStmt.pdf", 1): "BoA",
    }


# --- rules, keywords, caches, logs -----------------------------------------------------------

RULES = [("zelle ", None, [1, 5], "Rent"), ("Venmo", 850.0, None, "Rent"), ("zelle ", None, [1, 5], "Rent")]


def test_rules_document(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": [dict(zip(("description", "amount", "day_range", "category"), r)) for r in RULES]}, indent=4))
    got = load_rules(spark, str(path)).orderBy("rule_ord").collect()
    assert [(r.rule_ord, r.description, r.amount, r.day_range, r.category) for r in got] == [(i, *r) for i, r in enumerate(RULES)]


@pytest.mark.parametrize("form", ["lines", "document"])
def test_rules_round_trip(spark, tmp_path, form):
    rules = rules_table(spark, RULES)
    write_rules(rules, str(tmp_path / "out"), form)
    back = load_rules(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, rules.collect()))


def test_missing_rules_are_no_rules(spark, tmp_path):
    assert load_rules(spark, str(tmp_path / "none.json")).count() == 0


def test_starter_rules_in_order(spark):
    assert [r.description for r in starter_rules(spark).orderBy("rule_ord").collect()] == ["zelle ", "venmo", "paypal", "cash app"]


def test_keyword_file_keeps_order(spark, tmp_path):
    path = tmp_path / "keywords.json"
    path.write_text(json.dumps({"Z": ["b", "a"], "A": ["c"]}))
    got = builtin_keywords(spark, str(path)).orderBy("cat_ord", "kw_ord").collect()
    assert [(r.category, r.keyword) for r in got] == [("Z", "b"), ("Z", "a"), ("A", "c")]


def test_missing_or_unreadable_cache_is_empty(spark, tmp_path):
    assert load_cache(spark, str(tmp_path / "none"), NORMALIZE_CACHE).count() == 0


def test_prior_needs_its_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Description\n1,2\n")
    assert load_prior(spark, str(tmp_path / "a.csv")) is None
    assert load_prior(spark, str(tmp_path / "none.csv")) is None
    assert load_prior(spark, str(tmp_path / "a.csv"), ["Date"]).count() == 1


def test_log_tail_and_filters(spark, tmp_path):
    lines = []
    for i in range(30):
        lines.append(f"2024-01-01 00:00:{i:02d},123 - {'ERROR' if i % 3 == 0 else 'INFO'} - message {i}")
        if i % 10 == 0:
            lines.append("  traceback line")
    (tmp_path / "app.log").write_text("\n".join(lines) + "\n")
    log = read_log(spark, str(tmp_path / "app.log"))
    assert log.filter("level IS NULL").count() == 3
    assert [r.message for r in tail_log(filter_log(log, "ERROR"), 2).collect()] == ["message 24", "message 27"]
    assert [r.value for r in tail_log(log, 3).collect()] == lines[-3:]
    assert filter_log(log, contains="message 1").count() == 11
    assert log.filter(F.col("ts") == F.lit("2024-01-01 00:00:05").cast("timestamp")).count() == 1
