"""Reading statement exports."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import replace

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.functions.parsing import net_amount, parse_amount, parse_date, strip_currency
from coinsieve.functions.text import file_stem, let, strip
from coinsieve.operators.skew import attach
from coinsieve.session import materialize
from coinsieve.sources.layouts import (
    AMOUNT_MARKS, DATE_MARKS, LAYOUTS, TEXT_MARKS, UNKNOWN, Layout,
    identify_source, infer_layout, quoted, raw_amount,
)

ROW_ID = ["file", "block", "line_no"]
# Up to so many files are named in a filter, so that a read opens no others.
FEW_FILES = 1000
# How cells are quoted, in every reader: a doubled quote stands for one.
QUOTING = {"quote": '"', "escape": '"'}
# Lines are stitched by stretches of so many lines (a power of two), about so many lines to a task.
STRETCH_BITS = 13
LINES_PER_TASK = 500_000


def apply_layout(df: DataFrame, layout: Layout, *keep: str | Column, net_credit: bool = False) -> DataFrame:
    """Canonical raw_date, description and amount, picked by column name."""
    return df.select(
        quoted(layout.date).cast("string").alias("raw_date"),
        quoted(layout.description).alias("description"),
        raw_amount(layout, lambda name: quoted(name).cast("string"), net_credit).alias("amount"),
        *keep,
    )


# A line that ends inside a quoted cell. Quotes count at a cell's start only; after
# the closing one the cell goes on to the separator. Possessive, so nothing is tried twice.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
_OPENS = f'^(?:(?:{_QUOTED}"[^,]*+|(?!")[^,]*+),)*+{_QUOTED}\\z'


def opens(line: Column) -> Column:
    """True for a line that starts outside of a quoted cell and ends inside one."""
    return line.contains('"') & line.rlike(_OPENS)


def _strings(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def csv_parts(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> list[DataFrame]:
    """CSV rows of a path with their ``_file``, in parts: files without line breaks inside cells
    by Spark's reader, the others from stitched lines. All are read by block."""

    def read() -> DataFrameReader:
        return spark.read.options(ignoreCorruptFiles=False)

    file = F.col("_metadata.file_path")
    reader = read().options(header=True, enforceSchema=False, **QUOTING)
    rows = (reader if columns is None else reader.schema(_strings(columns))).csv(path)
    names = rows.columns
    lines = read().text(path)
    broken = materialize(lines.filter(opens(F.col("value"))).select(file.alias("file")).distinct())
    rows = rows.select("*", file.alias("_file"))
    if broken.isEmpty():
        return [rows]
    whole = broken.select(place(F.col("file")).alias("_place"))
    others = rows.withColumn("_place", place(F.col("_file"))).join(whole, "_place", "left_anti").drop("_place")
    records, unclosed = csv_records(csv_lines(among(lines, [], broken)))
    heads = materialize(first_records(records))
    # A name that Spark made up for an empty cell has no text to compare.
    cells = _cells(F.col("header"), len(names) + 1)
    differ = F.lit(False)
    for i, name in enumerate([*names, None]):
        cell = F.get(cells, F.lit(i))
        differ |= cell.isNotNull() if name in (None, f"_c{i}") else ~cell.eqNullSafe(F.lit(name))
    wrong = heads.filter(differ).select("file", F.lit("another header").alias("problem")).unionByName(unclosed).first()
    if wrong is not None:
        raise ValueError(f"{wrong.file}: {wrong.problem}")
    body = attach(records, heads.select("file", "head_no"), "file", ROW_ID, "inner").filter("block > 0 OR line_no <> head_no")
    stitched = body.select(F.col("file").alias("_file"), F.from_csv("value", _strings(names), {**QUOTING, "multiLine": "true"}).alias("_row"))
    return [others, stitched.select("_row.*", "_file")]


def read_layout(
    spark: SparkSession, path: str | list[str], layout: str | Layout, net_credit: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """All files of one export below a path or paths; they share one header, which
    ``columns`` tells where it should not be read from the first file.

    Only the layout's columns are read. Files with other headers belong to
    ``scan_statements``; here they fail instead of shifting columns.
    """
    known = LAYOUTS[layout] if isinstance(layout, str) else layout
    if net_credit and known.amount and known.source == "Capital One":
        known = replace(known, debit=known.amount, credit="Credit")
    return combine(*[
        apply_layout(rows, known, F.lit(known.source).alias("source"), F.col("_file").alias("file"), net_credit=net_credit)
        for rows in csv_parts(spark, path, columns)
    ])


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Files of one unknown export; NULL layout gives an empty table."""
    parts = csv_parts(spark, path)
    layout = infer_layout(parts[0].drop("_file").columns)
    if layout is None:
        layout = Layout(UNKNOWN, "a", "b", "c")
        parts = [spark.createDataFrame([], "a string, b string, c string, _file string")]
    source = F.lit(UNKNOWN).alias("source"), F.col("_file").alias("file")
    return combine(*[apply_layout(rows, layout, *source) for rows in parts])


def _cells(line: Column, width: int, places: Iterable[int] | None = None) -> Column:
    """The first ``width`` cells of a CSV line, or those at ``places``; missing ones are NULL."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return let(
        F.from_csv(line, schema, {**QUOTING, "multiLine": "true"}),
        lambda parsed: F.array(*[parsed[f"c{i}"] for i in (range(width) if places is None else places)]),
    )


def _names(cells: Column) -> Column:
    """Header names up to the last one; empty ones keep their place."""
    last = F.array_max(F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1)))
    return F.slice(F.transform(cells, strip), F.lit(1), F.coalesce(last, F.lit(0)))


def statement_name(path: Column, from_folder: bool = False) -> Column:
    """Name a file goes by: its own, or on request its folder's (an export that
    Spark wrote is a folder of part files)."""
    return file_stem(F.regexp_replace(path, "/[^/]*$", "") if from_folder else path)


def literal_path(path: str) -> str:
    """A path for Spark's readers that stands for itself, whatever signs it holds."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def csv_options(spark: SparkSession) -> DataFrameReader:
    # A fault ends the read, whatever the session says, so that its task is tried again.
    return spark.read.options(pathGlobFilter="*.[cC][sS][vV]", recursiveFileLookup=True, ignoreCorruptFiles=False)


def csv_reader(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return csv_options(spark).text(path)


def unreadable(spark: SparkSession, path: str, files: list[str]) -> list[str]:
    """Those of ``files`` whose read fails also when tried apart from the others.

    They are read by halves, of which only those that fail are read further.
    """
    try:
        csv_reader(spark, path).filter(place(F.col("_metadata.file_path")).isin(files)).write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JError):
        if len(files) == 1:
            return files
        half = len(files) // 2
        return unreadable(spark, path, files[:half]) + unreadable(spark, path, files[half:])
    return []


def among(found: DataFrame, but: list[str], only: DataFrame | None = None) -> DataFrame:
    """The files of a read without those in ``but``, or only the listed ones. Where few are
    listed, no other file is opened."""
    file = place(F.col("_metadata.file_path"))
    if but:
        found = found.filter(~file.isin(but))
    if only is None:
        return found
    listed = only.select(place(F.col("file")).alias("_place"))
    few = listed.limit(FEW_FILES + 1).collect()
    if len(few) <= FEW_FILES:
        return found.filter(file.isin([r._place for r in few]))
    return found.withColumn("_place", file).join(listed.distinct(), "_place", "left_semi").drop("_place")


def csv_lines(found: DataFrame) -> DataFrame:
    """(file, block, line_no, value) of every line of a text read."""
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        # Few lines have either sign, and a search for it is cheaper than the pattern.
        F.when(
            F.contains("value", F.lit("\r")) | F.startswith("value", F.lit("\ufeff")), F.regexp_replace("value", "\r$|^\ufeff", "")
        ).otherwise(F.col("value")).alias("value"),
    )


def file_facts(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(file, header, broken) of every CSV file that can be read to its end, and the files that cannot.

    ``header`` is the first line that is not blank; ``broken`` says whether a cell of the file
    goes over the end of a line. One read of the input, of which a row per file is kept.
    """

    def looked_at(but: list[str]) -> DataFrame:
        lines = csv_lines(among(csv_reader(spark, path), but))
        text = (F.col("block") == 0) & (F.trim("value") != "")
        first = F.min_by(F.when(text, F.col("value")), F.when(text, F.col("line_no")))
        # A set has an object for its buffer: lines are hashed by file and not sorted.
        open_lines = F.collect_set(F.when(opens(F.col("value")), F.lit(True)))
        return materialize(lines.groupBy("file").agg(first.alias("header"), (F.size(open_lines) > 0).alias("broken")))

    try:
        return looked_at([]), []
    except (PySparkException, Py4JError):
        # Without a bad file it was a fault that has passed, or not one of reading: that comes again.
        files = csv_files(spark, path).select(place(F.col("file")).alias("p")).collect()
        bad = unreadable(spark, path, [r.p for r in files])
        return looked_at(bad), bad


def place(file: Column) -> Column:
    """A path without its scheme: both spellings of a local path are equal."""
    return F.regexp_replace(file, "^[a-z]+:/+", "")


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """(file) of every CSV file below a path, from the listing: Spark plans no task
    for an empty file."""
    return spark.createDataFrame([(f,) for f in csv_reader(spark, path).inputFiles()], "file string")


def _inside(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``in0`` and ``in1``: whether a row starts inside a cell where its group starts
    outside (0) or inside (1) one, and ``out0``, ``out1`` for its end.

    ``shut`` and ``open`` say where a row that starts outside or inside ends. A row either
    keeps the side, changes it, or sets it; so the last one that sets it and the number
    of changes since then give the side.
    """
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum((F.col("shut") & ~F.col("open")).cast("long")).over(before), F.lit(0).cast("long"))
    sets = F.when(F.col("shut") == F.col("open"), F.struct(F.col("shut").alias("side"), "_turns"))
    since = F.pmod(F.col("_turns") - F.coalesce("_set._turns", F.lit(0)), F.lit(2)) == 1
    known = lines.withColumn("_turns", turns).withColumn("_set", F.last(sets, ignorenulls=True).over(before))
    for entry in (0, 1):
        side = F.coalesce("_set.side", F.lit(bool(entry)))
        known = known.withColumn(f"in{entry}", side != since)
        known = known.withColumn(f"out{entry}", F.when(F.col(f"in{entry}"), F.col("open")).otherwise(F.col("shut")))
    return known.drop("_turns", "_set")


def csv_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, block, line_no, value) of every non-blank record of the given lines, and the
    (file, problem) of files that end inside a cell.

    Lines that a cell spans become one record. Where a line starts is found by stretch of
    a block and then by one row per stretch, so no task holds a file or a block; the number of
    tasks follows from the number of lines. The lines are written once, so all passes see the
    same places.
    """
    lines = materialize(lines)
    tasks = max(1, -(-lines.count() // LINES_PER_TASK))
    stretch = ["file", "block", "stretch"]
    cut = lines.withColumn("stretch", F.shiftright("line_no", STRETCH_BITS)).repartition(tasks, *stretch)
    ends = cut.withColumns({"shut": opens(F.col("value")), "open": opens(F.concat(F.lit('"'), "value"))})
    sides = _inside(ends, stretch, ["line_no"]).drop("shut", "open")
    upto = Window.partitionBy(*stretch).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    for entry in (0, 1):
        start = F.when(~F.col(f"in{entry}"), F.struct("block", "line_no"))
        sides = sides.withColumn(f"start{entry}", F.last(start, ignorenulls=True).over(upto))
    sides = materialize(sides)
    # One row per stretch of a file from here on.
    last = F.max_by(F.struct(F.col("out0").alias("shut"), F.col("out1").alias("open"), "start0", "start1"), "line_no")
    parts = sides.groupBy(*stretch).agg(last.alias("x")).select(*stretch, "x.*")
    parts = _inside(parts, ["file"], ["block", "stretch"]).withColumnRenamed("in0", "entry")
    earlier = Window.partitionBy("file").orderBy("block", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.when(F.col("entry"), F.col("start1")).otherwise(F.col("start0"))
    parts = materialize(
        parts.withColumn("earlier", F.last(latest, ignorenulls=True).over(earlier))
        .withColumn("unclosed", F.max_by("out0", F.struct("block", "stretch")).over(Window.partitionBy("file")))
        .select(*stretch, "entry", "earlier", "unclosed")
    )
    unclosed = parts.filter("unclosed").select("file").distinct().withColumn("problem", F.lit("a quoted cell has no end"))

    def side(name: str) -> Column:
        return F.when(F.col("entry"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = attach(sides, parts.filter("NOT unclosed"), stretch, ROW_ID, "inner")
    placed = placed.select(*lines.columns, (side("in") | side("out")).alias("part"), F.coalesce(side("start"), "earlier").alias("start"))
    joined = (
        placed.filter("part")
        .groupBy("file", "start")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line_no", "value"))).alias("lines"))
        .select("file", "start.block", "start.line_no", F.array_join("lines.value", "\n").alias("value"))
    )
    records = materialize(placed.filter("NOT part").select(*lines.columns).unionByName(joined))
    return records.filter(F.trim("value") != ""), unclosed


def first_records(records: DataFrame) -> DataFrame:
    """(file, header, head_no): the first record of each file."""
    start = records.filter("block = 0")
    first = start.groupBy("file").agg(F.min("line_no").alias("line_no"))
    return start.join(first, ["file", "line_no"]).select("file", F.col("value").alias("header"), F.col("line_no").alias("head_no"))


def file_headers(heads: DataFrame, name_from_folder: bool = False) -> DataFrame:
    """(file, header, head_no) with the header's names, the bank and the layout they give."""
    # No header has more cells than separators and one.
    commas = F.length("header") - F.length(F.replace("header", F.lit(",")))
    width = (heads.agg(F.max(commas).alias("n")).first().n or 0) + 1
    names = heads.select(
        "file", "head_no",
        let(_cells(F.col("header"), width), _names).alias("names"),
        identify_source(statement_name(F.col("file"), name_from_folder)).alias("source"),
    )

    def first_named(marks: list[str]) -> Column:
        return F.get(F.filter("names", lambda n: F.lower(n).rlike("|".join(marks))), F.lit(0))

    debit, credit, total = first_named(["debit"]), first_named(["credit"]), first_named(["amount"])
    netted = debit.isNotNull() & credit.isNotNull() & total.isNull()
    guess = F.struct(
        first_named(DATE_MARKS).alias("date"),
        first_named(TEXT_MARKS).alias("description"),
        F.when(~netted, first_named(AMOUNT_MARKS)).alias("amount"),
        F.when(netted, debit).alias("debit"),
        F.when(netted, credit).alias("credit"),
        F.lit("credit").alias("sign"),
    )
    layout = F.when(F.col("source") == UNKNOWN, guess)
    for known in LAYOUTS.values():
        fixed = F.struct(
            *[F.lit(getattr(known, part)).cast("string").alias(part)
              for part in ("date", "description", "amount", "debit", "credit", "sign")]
        )
        layout = layout.when(F.col("source") == known.source, fixed)
    named = names.withColumn("layout", layout)
    money = F.when(F.col("layout.amount").isNotNull(), F.array("layout.amount")).otherwise(
        F.array("layout.debit", "layout.credit")
    )
    missing = F.filter(
        F.concat(F.array("layout.date", "layout.description"), money),
        lambda n: n.isNull() | ~F.coalesce(F.array_contains(F.col("names"), n), F.lit(False)),
    )
    return named.withColumn(
        "problem",
        F.when(F.size("names") < 1, F.lit("unreadable header")).when(
            F.size(missing) > 0,
            F.concat(F.lit("missing column: "), F.concat_ws(", ", F.transform(missing, lambda n: F.coalesce(n, F.lit("?"))))),
        ),
    )


def plain_cells(spark: SparkSession, path: str, but: list[str], width: int, places: list[int]) -> DataFrame:
    """(file, block, line_no, cells) of every row after the header of every CSV file, read
    by Spark's own reader, which parses only the cells at ``places``; right for files whose
    cells end on their line."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    found = csv_options(spark).options(header=True, **QUOTING).schema(schema).csv(path)
    return among(found, but).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), F.array(*[f"c{i}" for i in places]).alias("cells"),
    )


def scan_statements(
    spark: SparkSession, path: str | list[str], on_error: str = "skip", name_from_folder: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of every CSV below a folder, and the files that gave none.

    Each file's own header decides which cell is which, so column order, extra
    columns and mixed exports need no separate reads. A first read finds the headers and the files
    whose cells span lines; the rows come from a second one and are not copied in
    between. Only the lines of such files are written, to find where their cells end. Rejected files come back
    as (file, problem), empty ones too; ``on_error='fail'`` raises for the first one
    instead. With ``name_from_folder`` a file goes by its folder's name.
    """
    facts, bad = file_facts(spark, path)
    broken = materialize(facts.filter("broken").select("file"))
    heads = facts.filter("NOT broken AND header IS NOT NULL").select("file", "header", F.lit(None).cast("bigint").alias("head_no"))
    records = None
    rejects = spark.createDataFrame([], "file string, problem string")
    if not broken.isEmpty():
        records, rejects = csv_records(csv_lines(among(csv_reader(spark, path), bad, broken)))
        heads = heads.unionByName(first_records(records))
    headers = materialize(file_headers(materialize(heads), name_from_folder))
    problems = headers.filter("problem IS NOT NULL").select("file", "problem").unionByName(rejects)
    seen = headers.select("file").unionByName(rejects.select("file"))
    at = place(F.col("file"))
    silent = csv_files(spark, path).withColumn("p", at).join(seen.select(at.alias("p")), "p", "left_anti").drop("p")
    rejected = materialize(problems.unionByName(silent.withColumn("problem", F.lit("empty or unreadable file"))))
    if on_error == "fail":
        first = rejected.first()
        if first is not None:
            raise ValueError(f"{first.file}: {first.problem}")
    usable = headers.filter("problem IS NULL").select("file", "head_no", "names", "source", "layout")
    # Lines are parsed as wide as the widest header, not wider, and of their cells only
    # those that the layout of some file names.
    width = usable.agg(F.max(F.size("names")).alias("n")).first().n or 1
    parts = ["date", "description", "amount", "debit", "credit"]
    at = [F.nullif(F.array_position("names", F.col(f"layout.{p}")), F.lit(0)).cast("int") - 1 for p in parts]
    named = usable.select(F.explode(F.array(*at)).alias("i")).filter("i IS NOT NULL").distinct()
    places = sorted(r.i for r in named.collect()) or [0]
    slot = F.create_map(*[F.lit(n) for pair in zip(places, range(len(places)), strict=True) for n in pair])
    slots = F.struct(*[F.when(i.isNotNull(), F.try_element_at(slot, i)).alias(p) for p, i in zip(parts, at, strict=True)])
    usable = materialize(usable.select("file", "head_no", "source", "layout", slots.alias("slots")))
    body = attach(
        plain_cells(spark, path, bad, width, places), usable.filter("head_no IS NULL").drop("head_no"), "file", ROW_ID, "inner"
    )
    if records is not None:
        stitched = attach(records, usable.filter("head_no IS NOT NULL"), "file", ROW_ID, "inner")
        stitched = stitched.filter("block > 0 OR line_no <> head_no").withColumn("cells", _cells(F.col("value"), width, places))
        body = body.unionByName(stitched.select(*body.columns))

    def cell(part: str) -> Column:
        return F.get(F.col("cells"), F.col(f"slots.{part}"))

    def money(part: str) -> Column:
        return parse_amount(strip_currency(cell(part)))

    netted = F.when(
        F.col("layout.sign") == "debit", net_amount(money("debit"), money("credit"), "debit")
    ).otherwise(net_amount(money("debit"), money("credit"), "credit"))
    return (
        body.select(
            "file", "block", "line_no", "source",
            cell("date").alias("raw_date"),
            cell("description").alias("description"),
            F.when(F.col("layout.amount").isNotNull(), money("amount")).otherwise(netted).alias("amount"),
        ),
        rejected,
    )


def typed(rows: DataFrame) -> DataFrame:
    """Date column next to the parsed amount; bad dates become NULL."""
    return rows.withColumn("date", parse_date(F.col("raw_date")))


def combine(*parts: DataFrame) -> DataFrame:
    """Union by name; columns a part lacks are NULL."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
