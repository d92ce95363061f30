"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations alone.

A token budget flows down a tree domain - language - source.  At each node it is dealt to the children by their weights
(whole numbers; not listed: 1).  A child can take what its leaves hold in ``max_epochs`` epochs; what it can't take goes
to its siblings in proportion to their weights, and only what no sibling can take is missed by the parent, whose own
siblings got it beforehand because a parent never asks for more than its leaves hold.  All of it is integer arithmetic:
children take whole tokens, so less than one token for each child stays undealt.

A leaf's share is some whole epochs and the beginning of one more.  Every epoch has its own order, by an MD5 of seed,
epoch, id and text.  The place where the last epoch is cut is found without sorting a leaf: token sums of hash slices
tell the slice that holds the cut, and only that slice's rows (about ``SLICE_ROWS``) are put in order.  So a leaf may hold
a third of all rows.  The row at the cut counts with the tokens still missing (n_take < n_tokens).

Null domain, language and source are names of their own (empty string).  Null and empty texts have no tokens; they come
along in whole epochs and where their hash stands before the cut.  Rows that agree in id and text have one place in an
epoch; if the cut falls among them they are counted one by one, and those beyond it stay out.  An empty table gives an
empty result.  Columns of docs may have any names.

Nothing is dealt by leaf alone: the few numbers of each leaf are broadcast to the rows if there are at most
``BROADCAST_LEAVES`` leaves (counted first); beyond that the rows are joined with them by leaf, which adaptive execution
splits where a leaf is large, and the last slices by (leaf, slice).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, masked, table

SLICE_ROWS = 4096
#: Leaves whose shares are broadcast: 100 bytes each, some megabytes.
BROADCAST_LEAVES = 50_000
HASH_BITS = 60
KEYS = ("__domain", "__lang", "__source")


def domain_of(source: Column) -> Column:
    """The domain of a numbered source: by the number's remainder; without a number ``other``."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    return F.when(number == "", "other").otherwise(F.element_at(F.array(F.lit("web"), F.lit("books"), F.lit("code")), (number.cast("int") % 3) + 1))


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, int(v))]) if weights else None
    return (F.coalesce(known[name], F.lit(1)) if weights else F.lit(1)).cast("bigint")


def water_fill(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``share``: the column budget (the parent's) dealt by weight to children that can take at most cap."""
    rows = children.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)).cast("bigint"))
    rows = rows.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0)))
    whole = Window.partitionBy(*parent)
    before = whole.orderBy("ratio", "name").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"c0": F.coalesce(F.sum("cap").over(before), F.lit(0)), "w0": F.coalesce(F.sum("weight").over(before), F.lit(0)), "w": F.sum("weight").over(whole)})
    rows = rows.withColumn("full", F.expr("cap * (w - w0) <= weight * (budget - c0)"))
    rows = rows.withColumns({"taken": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(F.lit(0))).over(whole), "left": F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(whole)})
    return rows.withColumn("share", F.expr("CASE WHEN full THEN cap ELSE greatest(0, (budget - taken) * weight div left) END")).drop("ratio", "c0", "w0", "w", "full", "taken", "left")


def leaf_shares(leaves: DataFrame, *, weights: tuple[Mapping[str, int], ...], max_epochs: int, budget: int | None, part: tuple[int, int]) -> DataFrame:
    """Leaves (three keys, rows, tokens) with their share of the budget, or of part of all tokens."""
    held = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg((F.lit(budget).cast("bigint") if budget is not None else F.expr(f"coalesce(sum(tokens), 0) * {part[0]} div {part[1]}")).alias("budget"))
    above, parent = total, []
    for depth, key in enumerate(KEYS):
        keys = list(KEYS[: depth + 1])
        level = held.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.first("rows").alias("rows"), F.first("tokens").alias("tokens"))
        level = level.join(above, parent) if parent else level.crossJoin(F.broadcast(above))  # one row
        level = level.withColumns({"name": F.col(key), "weight": _weight(F.col(key), weights[depth])})
        shared = water_fill(level, parent or [F.lit(0)])
        if depth == len(KEYS) - 1:
            return shared.select(*keys, "rows", "tokens", "share")
        above, parent = shared.select(*keys, F.col("share").alias("budget")), keys
    raise AssertionError


def _order(seed: int, epoch: Column) -> Column:
    """A number of HASH_BITS bits for a row's place in an epoch."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("__id"), F.lit("")), F.col("__text_hash"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def keyed(df: DataFrame, *, id_col: str, text_col: str, domain: Column, lang_col: str, source_col: str) -> DataFrame:
    """df with the columns that decide: three keys, tokens, id and a hash of the text."""
    own = {"__domain": domain, "__lang": F.col(lang_col), "__source": F.col(source_col)}
    return df.withColumns({k: F.coalesce(c.cast("string"), F.lit("")) for k, c in own.items()} | {
        "__n": token_count(F.col(text_col)), "__id": F.col(id_col).cast("string"),
        "__text_hash": F.substring(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), 1, 16),
    })


def plan(rows: DataFrame, *, weights: tuple[Mapping[str, int], ...], max_epochs: int, budget: int | None, part: tuple[int, int], seed: int) -> DataFrame:
    """For each leaf: whole epochs, tokens of the last one (__rest), the hash at its cut, the tokens before that, and how many rows stand at it."""
    leaves = cut(rows.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.sum("__n").alias("tokens")))
    shares = leaf_shares(leaves, weights=weights, max_epochs=max_epochs, budget=budget, part=part)
    shares = cut(shares.filter("share > 0").selectExpr(*KEYS, "share div tokens AS __epochs", "share % tokens AS __rest", f"greatest(0, cast(ceil(log2(rows / {SLICE_ROWS})) AS int)) AS __bits"))
    cutting = shares.filter("__rest > 0")
    placed = rows.select(*KEYS, "__n", "__id", "__text_hash").join(small(cutting), list(KEYS))
    placed = placed.withColumn("__h", _order(seed, F.col("__epochs"))).withColumn("__slice", F.expr(f"shiftright(__h, {HASH_BITS} - __bits)"))
    leaf = Window.partitionBy(*KEYS)
    sums = placed.groupBy(*KEYS, "__slice", "__rest").agg(F.sum("__n").alias("own"))
    sums = sums.withColumn("until", F.sum("own").over(leaf.orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)))
    edge = cut(sums.filter("until >= __rest and until - own < __rest").selectExpr(*KEYS, "__slice", "until - own AS before"))
    inside = placed.join(small(edge, "__slice"), [*KEYS, "__slice"]).groupBy(*KEYS, "__h", "__rest", "before").agg(F.sum("__n").alias("own"), F.count("*").alias("ties"))
    inside = inside.withColumn("until", F.col("before") + F.sum("own").over(leaf.orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)))
    cuts = inside.filter("until >= __rest and until - own < __rest").selectExpr(*KEYS, "__h AS __cut", "until - own AS __before", "ties AS __ties")
    return cut(shares.join(cuts, list(KEYS), "left").drop("__bits"))


def small(leaves: DataFrame, *also: str) -> DataFrame:
    """leaves for a join with rows: broadcast if there are few (they are written already, so counting is cheap), else dealt by leaf and also."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves.repartition(*KEYS, *also)


def select(rows: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """rows, once for each epoch that takes them, with __epoch and __take (tokens)."""
    found = rows.join(small(leaves), list(KEYS)).withColumn("__h", F.when(F.col("__rest") > 0, _order(seed, F.col("__epochs"))))
    last = F.when((F.col("__rest") > 0) & (F.col("__h") <= F.col("__cut")), F.array(F.col("__epochs"))).otherwise(F.expr("array(CAST(null AS bigint))"))
    whole = F.when(F.col("__epochs") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("__epochs") - 1)).otherwise(F.expr("CAST(array() AS array<bigint>)"))
    found = found.withColumn("__epoch", F.explode(F.array_compact(F.concat(whole, last))))
    at_cut = (F.col("__epoch") == F.col("__epochs")) & (F.col("__h") == F.col("__cut"))
    left = F.col("__rest") - F.col("__before")
    if leaves.filter("__ties > 1").isEmpty():
        return found.withColumn("__take", F.when(at_cut, F.least(F.col("__n"), left)).otherwise(F.col("__n")))
    tied = at_cut & (F.col("__ties") > 1)
    one = found.filter(~F.coalesce(tied, F.lit(False))).withColumn("__take", F.when(at_cut, F.least(F.col("__n"), left)).otherwise(F.col("__n")))
    many = found.filter(tied).withColumn("__k", F.row_number().over(Window.partitionBy(*KEYS, "__h").orderBy("__id")) - 1)
    many = many.withColumn("__take", F.least(F.col("__n"), left - F.col("__k") * F.col("__n"))).filter("__take > 0").drop("__k")
    return one.unionByName(many)


# Production parameters: weights by domain, language and source, half of all tokens, at most two epochs.
WEIGHTS = ({"web": 5, "books": 3, "code": 2, "other": 1}, {"en": 4, "de": 2, "fr": 2, "es": 2}, {"src0": 3})
PART, MAX_EPOCHS, SEED = (1, 2), 2, 17


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = keyed(docs, id_col="doc_id", text_col="text", domain=domain_of(F.col("source")), lang_col="lang", source_col="source")
    rows = cut(rows.select("doc_id", *KEYS, "__n", "__id", "__text_hash"))
    leaves = plan(rows, weights=WEIGHTS, max_epochs=MAX_EPOCHS, budget=None, part=PART, seed=SEED)
    return select(rows, leaves, SEED).selectExpr("doc_id", "__domain AS domain", "__lang AS lang", "__source AS source", "__epoch AS epoch", "__n AS n_tokens", "__take AS n_take")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, *, part: tuple[int, int] = (9, 10)) -> DataFrame:
    """The documents of a mixture of part of the tokens that come in; one that two epochs take stands there twice."""
    named, c = masked(docs)
    rows = keyed(named, id_col=c["doc_id"], text_col=c["text"], domain=domain_of(F.col(c["source"])), lang_col=c["lang"], source_col=c["source"])
    slim = cut(rows.select(*KEYS, "__n", "__id", "__text_hash"))
    leaves = plan(slim, weights=WEIGHTS, max_epochs=MAX_EPOCHS, budget=None, part=part, seed=SEED)
    return select(rows, leaves, SEED).select(*c.values()).toDF(*docs.columns)


QUERIES = {"op2_source_mixing": op2_source_mixing}


def oracle(docs: str = "documents", part: tuple[int, int] = PART) -> str:
    """The same in DuckDB SQL; docs: a table's name."""
    case = lambda col, weights: "CASE " + col + " ".join(["", *[f"WHEN '{k}' THEN {v}" for k, v in weights.items()]]) + " ELSE 1 END"
    levels, above, keys = [], f"(SELECT CAST(coalesce(sum(tokens), 0) AS BIGINT) * {part[0]} // {part[1]} AS budget FROM leaves)", []
    for depth, key in enumerate(("domain", "lang", "source")):
        mine = [*keys, key]
        on = " AND ".join(f"x.{k} = a.{k}" for k in keys) or "true"
        over = f"PARTITION BY {', '.join(keys)}" if keys else ""
        levels.append(f"""
c{depth} AS (SELECT x.*, a.budget, {case("x." + key, WEIGHTS[depth])} AS weight
       FROM (SELECT {", ".join(mine)}, CAST(sum(tokens) AS BIGINT) * {MAX_EPOCHS} AS cap FROM leaves GROUP BY ALL) x JOIN {above} a ON {on}),
f{depth} AS (SELECT *, cap * (sum(weight) OVER ({over}) - w0) <= weight * (budget - c0) AS sat FROM
       (SELECT *, coalesce(sum(cap) OVER o, 0) AS c0, coalesce(sum(weight) OVER o, 0) AS w0 FROM c{depth}
        WINDOW o AS ({over} ORDER BY cap / weight, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
s{depth} AS (SELECT {", ".join(mine)}, CAST(CASE WHEN sat THEN cap ELSE greatest(0, (budget - sum(CASE WHEN sat THEN cap ELSE 0 END) OVER ({over})) * weight
       // sum(CASE WHEN sat THEN 0 ELSE weight END) OVER ({over})) END AS BIGINT) AS budget FROM f{depth})""")
        above, keys = f"s{depth}", mine
    return rf"""
WITH rows0 AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
       regexp_extract(coalesce(source, ''), '(\d{{1,9}})$', 1) AS num, substr(md5(coalesce(text, '')), 1, 16) AS th FROM {docs}),
r AS (SELECT * EXCLUDE (num), CASE WHEN num = '' THEN 'other' ELSE ['web', 'books', 'code'][CAST(num AS INT) % 3 + 1] END AS domain FROM rows0),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM r GROUP BY ALL),{",".join(levels)},
p AS (SELECT s2.*, s2.budget // l.tokens AS epochs, s2.budget % l.tokens AS rest FROM s2 JOIN leaves l ON s2.domain = l.domain AND s2.lang = l.lang AND s2.source = l.source WHERE s2.budget > 0),
o AS (SELECT r.*, epochs, rest, CAST('0x' || substr(md5('{SEED}|' || epochs || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || th), 1, {HASH_BITS // 4}) AS BIGINT) AS h
      FROM r JOIN p ON r.domain = p.domain AND r.lang = p.lang AND r.source = p.source),
b AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM o),
k AS (SELECT *, min(CASE WHEN rest > 0 AND until >= rest AND before < rest THEN h END) OVER (PARTITION BY domain, lang, source) AS cut_h,
             row_number() OVER (PARTITION BY domain, lang, source, h ORDER BY doc_id) - 1 AS tie FROM b),
e AS (SELECT *, unnest(range(CAST(epochs AS BIGINT) + CASE WHEN rest > 0 AND h <= cut_h THEN 1 ELSE 0 END)) AS epoch FROM k)
SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, CAST(n_tokens AS BIGINT) AS n_tokens,
       CAST(CASE WHEN epoch = epochs AND h = cut_h THEN least(n_tokens, rest - before - tie * n_tokens) ELSE n_tokens END AS BIGINT) AS n_take FROM e
WHERE NOT (epoch = epochs AND h = cut_h AND rest - before - tie * n_tokens <= 0)
"""


ORACLE = {"op2_source_mixing": oracle()}
