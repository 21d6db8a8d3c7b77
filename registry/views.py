"""Transaction-shaped views over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinsieve.functions.parsing import net_amount
from coinsieve.operators.rows import normalized
from coinsieve.sources.tables import keyword_table, rules_table


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- events as transactions ----------------------------------------------------


def txn_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    amount = F.round("value")
    return normalized(
        table(spark, sf, "events").select(
            F.col("event_id").cast("string").alias("txn_id"),
            F.col("event_id").alias("seq"),
            F.to_date("ts").alias("date"),
            F.when(F.col("event_type") == "error", 0 - amount).otherwise(amount).alias("amount"),
            F.concat("event_type", F.lit(" ONLINE  *K"), k).alias("description"),
            F.col("event_type").alias("source"),
            k.cast("int").alias("k"),
        )
    )


NORMALIZE_SQL = (
    "trim(regexp_replace(replace(replace(replace(replace(replace(trim(lower({c})),"
    "'ach debit',''),'ach credit',''),'online',''),'payment',''),'*',''),'\\s+',' ','g'))"
)

TXN = f"""
txn AS (
  SELECT *, {NORMALIZE_SQL.format(c='description')} AS normalized_desc FROM (
    SELECT CAST(event_id AS VARCHAR) AS txn_id, event_id AS seq, CAST(ts AS DATE) AS date,
           CASE WHEN event_type = 'error' THEN 0 - round(value) ELSE round(value) END AS amount,
           event_type || ' ONLINE  *K' || regexp_extract(props, '([0-9]+)', 1) AS description,
           event_type AS source,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
    FROM events))"""


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a category, a score and a reason that follow from the row."""
    k = F.col("k")
    label = (
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(F.col("source") == "purchase", "Shopping")
        .when(F.col("source") == "view", "Entertainment")
        .when(F.col("source") == "click", "Travel")
        .when(F.col("source") == "signup", "Subscriptions")
        .otherwise("Uncategorized")
    )
    reason = F.when(
        F.col("source") == "error",
        F.concat(
            F.lit("Low confidence (0."), F.lpad(k.cast("string"), 2, "0"),
            F.lit(") for 'Food'. Original reasoning: looks like "), F.col("normalized_desc"),
        ),
    ).otherwise(F.concat(F.lit("Matched "), F.col("source")))
    return txn_events(spark, sf).withColumns(
        {
            "category": label,
            "confidence": F.when(k % 13 != 0, k / 100.0),
            "reasoning": reason,
            "match_type": F.when(k % 3 == 0, "exact").when(k % 3 == 1, "fuzzy").otherwise("model"),
        }
    )


SCORED = (
    TXN
    + """,
scored AS (
  SELECT *,
    CASE WHEN k % 17 = 0 THEN NULL WHEN source = 'purchase' THEN 'Shopping'
         WHEN source = 'view' THEN 'Entertainment' WHEN source = 'click' THEN 'Travel'
         WHEN source = 'signup' THEN 'Subscriptions' ELSE 'Uncategorized' END AS category,
    CASE WHEN k % 13 <> 0 THEN k / 100.0::DOUBLE END AS confidence,
    CASE WHEN source = 'error'
         THEN 'Low confidence (0.' || lpad(CAST(k AS VARCHAR), 2, '0')
              || ') for ''Food''. Original reasoning: looks like ' || normalized_desc
         ELSE 'Matched ' || source END AS reasoning,
    CASE k % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy' ELSE 'model' END AS match_type
  FROM txn)"""
)


def corrected_events(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections of the rows that have no category worth keeping; rows with an
    even k are corrected twice."""
    rows = scored_events(spark, sf).filter("category = 'Uncategorized' OR category = 'Travel'")
    turns = F.when(F.col("k") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    turn = F.col("turn")
    return (
        rows.withColumn("turn", F.explode(turns))
        .withColumn("original_category", F.col("category"))
        .withColumn(
            "new_category",
            F.when(turn == 2, "Fees").when(F.col("source") == "error", "Food").otherwise("Rent"),
        )
        .withColumn("correction_ord", F.col("seq") * 2 + turn)
    )


CORRECTED = (
    SCORED
    + """,
corrected AS (
  SELECT s.*, t.turn, s.category AS original_category,
         CASE WHEN t.turn = 2 THEN 'Fees' WHEN source = 'error' THEN 'Food' ELSE 'Rent' END AS new_category,
         s.seq * 2 + t.turn AS correction_ord
  FROM scored s JOIN (VALUES (1), (2)) t(turn) ON t.turn = 1 OR s.k % 2 = 0
  WHERE category = 'Uncategorized' OR category = 'Travel')"""
)


# --- line items as transactions ---------------------------------------------------


def txn_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag",
        F.to_date("l_shipdate").alias("date"),
    )
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    joined = line.join(part, line.l_partkey == part.p_partkey)
    price = F.col("l_extendedprice")
    return normalized(
        joined.select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in
                               ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("txn_id"),
            F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
            "date",
            F.when(F.col("l_returnflag") == "R", 0 - price).otherwise(price).alias("amount"),
            F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("description"),
            F.col("l_returnflag").alias("source"),
            F.col("p_type"), F.col("p_name"),
        )
    )


LINE = f"""
line AS (
  SELECT *, {NORMALIZE_SQL.format(c='description')} AS normalized_desc FROM (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS txn_id,
           CAST(l_shipdate AS DATE) AS date,
           CASE WHEN l_returnflag = 'R' THEN 0 - l_extendedprice ELSE l_extendedprice END AS amount,
           concat_ws(' ', p_brand, p_type, p_name) AS description,
           l_returnflag AS source, p_type, p_name
    FROM lineitem JOIN part ON l_partkey = p_partkey))"""


# Types of part taken as known with confidence, unknown, and unsure.
def scored_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Line items categorized by return flag: R unknown, A sure, N unsure."""
    flag = F.col("source")
    return txn_lineitem(spark, sf).withColumns(
        {
            "category": F.when(flag == "R", "Uncategorized").otherwise(F.col("p_type")),
            "confidence": F.when(flag == "R", F.lit(0.0)).when(flag == "A", F.lit(0.95)).otherwise(F.lit(0.5)),
            "reasoning": F.lit("by type"),
        }
    )


SCORED_LINE = (
    LINE
    + """,
scored AS (
  SELECT *, CASE WHEN source = 'R' THEN 'Uncategorized' ELSE p_type END AS category,
         CASE source WHEN 'R' THEN 0.0::DOUBLE WHEN 'A' THEN 0.95::DOUBLE ELSE 0.5::DOUBLE END AS confidence
  FROM line)"""
)


def raw_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Debit and credit columns; each row has one of them."""
    price = F.col("l_extendedprice")
    back = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(~back, price).alias("debit"), F.when(back, price).alias("credit")
    )


RAW_LINE = """
raw AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS debit,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS credit
  FROM lineitem)"""


# --- orders as raw text -----------------------------------------------------------


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order exports as text: three date styles, some bad dates and amounts."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key,
        F.when(key % 50 == 0, "n/a")
        .when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
        .alias("Order Date"),
        F.concat(F.lit("  Order "), "o_orderpriority", F.lit(" ")).alias("Order Desc"),
        F.when(key % 70 == 0, "1.0d")
        .when(key % 2 == 0, F.concat(F.lit("-$"), F.format_number("o_totalprice", 2)))
        .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
        .alias("Order Amount"),
    )


RAW_ORDERS = """
raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
         WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%-m/%-d/%Y')
         ELSE strftime(o_orderdate, '%m/%d/%Y') END AS "Order Date",
    '  Order ' || o_orderpriority || ' ' AS "Order Desc",
    CASE WHEN o_orderkey % 70 = 0 THEN '1.0d'
         WHEN o_orderkey % 2 = 0 THEN '-$' || format('{:,.2f}', o_totalprice)
         ELSE '$' || format('{:,.2f}', o_totalprice) END AS "Order Amount"
  FROM orders)"""

PARSE_DATE_SQL = (
    "CAST(coalesce(try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%Y-%m-%d')) AS DATE)"
)
PARSE_AMOUNT_SQL = (
    "CASE WHEN regexp_matches(replace(replace({c}, '$', ''), ',', ''), "
    "'^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
    "THEN TRY_CAST(replace(replace({c}, '$', ''), ',', '') AS DOUBLE) END"
)


# --- small rule and keyword tables ------------------------------------------------

KEYWORDS = {
    "A": ["purchse"],
    "B": ["purchase", "sign"],
    "C": ["erorr", "view"],
    "D": ["k 4", "clck"],
}

KEYWORD_ROWS = [
    (c, category, k, word)
    for c, (category, words) in enumerate(KEYWORDS.items())
    for k, word in enumerate(words)
]
KW = "kw AS (SELECT * FROM (VALUES " + ", ".join(
    f"({c}, '{cat}', {k}, '{word}')" for c, cat, k, word in KEYWORD_ROWS
) + ") v(cat_ord, category, kw_ord, keyword))"

RULES = [
    ("widget", None, [1, 5], "A"),
    ("Gizmo ", None, [1, 31], "B"),
    ("bolt", 60000.0, [1, 31], "D"),
    ("widget", None, None, "C"),
    ("econmy", None, [10, 12], "E"),
    ("Brand#1", None, [28, 31], "F"),
]


def _rule_sql(i: int, rule: tuple) -> str:
    text, amount, days, category = rule
    low, high = (days or ["NULL", "NULL"])
    return f"({i}, '{text}', {amount if amount is not None else 'NULL'}::DOUBLE, {low}::INTEGER, {high}::INTEGER, '{category}')"


RULE = "rule AS (SELECT * FROM (VALUES " + ", ".join(
    _rule_sql(i, r) for i, r in enumerate(RULES)
) + ") v(rule_ord, description, amount, low, high, category))"


def fixture_keywords(spark: SparkSession) -> DataFrame:
    return keyword_table(spark, KEYWORDS)


def fixture_rules(spark: SparkSession) -> DataFrame:
    return rules_table(spark, RULES)


def edit_scores_sql(pairs: str) -> str:
    """CTE ``score`` (text, word, score) for a CTE of distinct (text, word)."""
    return f"""
sized AS (
  SELECT text, word,
         CASE WHEN length(word) <= length(text) THEN word ELSE text END AS s,
         CASE WHEN length(word) <= length(text) THEN text ELSE word END AS l
  FROM {pairs}),
wide AS (
  SELECT *, length(s) AS ls, unnest([length(s) - 1, length(s), length(s) + 1]) AS w FROM sized
  WHERE length(s) > 0),
placed AS (
  SELECT *, unnest(generate_series(1, length(l) - w + 1)) AS i FROM wide
  WHERE w >= 1 AND w <= length(l)),
score AS (
  SELECT text, word,
         max((200 * (greatest(ls, w) - levenshtein(s, substr(l, i, w))) + greatest(ls, w))
             // (2 * greatest(ls, w))) AS score
  FROM placed GROUP BY text, word)"""


def _blocks_sql(name: str, pairs: str) -> str:
    """Recursive CTE ``{name}_found``: the matching blocks (i, j, k) of the texts s and l of each
    (id, s, l). The longest block that starts first splits a pair into what lies before and after it."""
    return f"""
{name}_equal AS (
  SELECT id, i, j, j - i AS d FROM (
    SELECT id, s, l, i, unnest(range(length(l))) AS j FROM (SELECT *, unnest(range(length(s))) AS i FROM {pairs}))
  WHERE s[i + 1] = l[j + 1]),
{name}_cells AS (
  SELECT id, i, j, max(i) OVER (PARTITION BY id, d, g) - i + 1 AS k
  FROM (SELECT *, i - row_number() OVER (PARTITION BY id, d ORDER BY i) AS g FROM {name}_equal)),
{name}_found(id, i0, i1, j0, j1, i, j, k) AS (
  SELECT id, 0::BIGINT, length(s), 0::BIGINT, length(l), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM {pairs}
  UNION ALL
  SELECT id, CASE side WHEN 0 THEN i0 ELSE b.i + b.k END, CASE side WHEN 0 THEN b.i ELSE i1 END,
         CASE side WHEN 0 THEN j0 ELSE b.j + b.k END, CASE side WHEN 0 THEN b.j ELSE j1 END,
         CASE side WHEN 0 THEN b.i END, CASE side WHEN 0 THEN b.j END, CASE side WHEN 0 THEN b.k END
  FROM (
    SELECT id, i0, i1, j0, j1, unnest([0, 1]) AS side,
           arg_max({{'i': c.i, 'j': c.j, 'k': least(c.k, i1 - c.i, j1 - c.j)}}, (least(c.k, i1 - c.i, j1 - c.j), -c.i, -c.j)) AS b
    FROM {name}_found f JOIN {name}_cells c USING (id)
    WHERE c.i >= i0 AND c.i < i1 AND c.j >= j0 AND c.j < j1
    GROUP BY id, i0, i1, j0, j1))"""


def ratio_scores_sql(pairs: str) -> str:
    """As ``edit_scores_sql`` for the matching-block ratio; needs WITH RECURSIVE. Texts
    shorter than 200 letters."""
    return f"""
ratio_pairs AS (
  SELECT row_number() OVER () AS id, text, word,
         CASE WHEN length(word) <= length(text) THEN word ELSE text END AS s,
         CASE WHEN length(word) <= length(text) THEN text ELSE word END AS l
  FROM {pairs} WHERE length(text) > 0 AND length(word) > 0),
{_blocks_sql('whole', 'ratio_pairs')},
ratio_windows AS (
  SELECT row_number() OVER () AS id, id AS pair, s, l FROM (
    SELECT DISTINCT p.id, p.s, substr(p.l, a + 1, length(p.s)) AS l FROM ratio_pairs p JOIN (
      SELECT id, greatest(j - i, 0) AS a FROM whole_found WHERE k IS NOT NULL
      UNION ALL SELECT id, length(l) - length(s) FROM ratio_pairs) USING (id))),
{_blocks_sql('part', 'ratio_windows')},
ratio_matched AS (SELECT id, coalesce(sum(k), 0) AS m FROM part_found GROUP BY id),
score AS (
  SELECT text, word, CASE WHEN max(r) > 0.995 THEN 100 ELSE round_even(100 * max(r), 0) END AS score
  FROM (SELECT pair, 2.0::DOUBLE * m / (length(s) + length(l)) AS r FROM ratio_windows JOIN ratio_matched USING (id))
  JOIN ratio_pairs ON id = pair GROUP BY text, word)"""


def raw_split(spark: SparkSession, sf: str, sign: str) -> DataFrame:
    return raw_lineitem(spark, sf).withColumn("amount", net_amount(F.col("debit"), F.col("credit"), sign))
