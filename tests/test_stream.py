"""Restart safety of streaming ingestion."""

import pytest

from coinsieve.streaming.ingest import ingest_stream, statement_stream, upsert_batch, upsert_stream

HEADER = ["Date", "Description", "Amount"]


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")


def land(folder, name, *rows):
    (folder / "in" / name).write_text("Date,Description,Amount\n" + "".join(f"{d},{t},{a}\n" for d, t, a in rows))


def test_files_are_read_once_over_restarts(spark, places):
    base, inputs, out, state = places
    land(base, "1.csv", ("01/05/2024", "A", 1), ("bad", "B", 2))
    for _ in range(2):
        ingest_stream(statement_stream(spark, inputs, "amex", HEADER), out, state).awaitTermination()
    land(base, "2.csv", ("01/06/2024", "C", 3))
    ingest_stream(statement_stream(spark, inputs, "amex", HEADER), out, state).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted(r.description for r in got) == ["A", "B", "C"]
    assert {r.source for r in got} == {"AMEX"}


def test_upsert_drops_repeats_within_and_across_batches(spark, places):
    base, inputs, out, state = places
    land(base, "1.csv", ("01/05/2024", "A", 1), ("01/05/2024", "a ", -1), ("bad", "B", 2))
    upsert_stream(statement_stream(spark, inputs, "amex", HEADER), out, state).awaitTermination()
    land(base, "2.csv", ("01/05/2024", "A", 1), ("01/06/2024", "C", 3), ("bad", "B", 2))
    upsert_stream(statement_stream(spark, inputs, "amex", HEADER), out, state).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.description.strip(), r.epoch) for r in got.collect()) == [("A", 0), ("B", 0), ("B", 1), ("C", 1)]


def test_replayed_batch_leaves_the_same_rows(spark, places, txns):
    out = places[2]
    write = upsert_batch(out)
    first, second = txns([("A", 1.0, "2024-01-01")]), txns([("A", 1.0, "2024-01-01"), ("B", 2.0, "2024-01-01")])
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert sorted(r.description for r in spark.read.parquet(out).collect()) == ["A", "B"]


def test_a_batch_of_repeats_stores_nothing(spark, places, txns):
    out = places[2]
    write = upsert_batch(out)
    rows = txns([("A", 1.0, "2024-01-01")])
    write(rows, 0)
    write(rows, 1)
    assert spark.read.parquet(out).count() == 1
