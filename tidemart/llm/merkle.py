"""Merkle manifest of a table: a tree per source, a tree over the sources, and a proof per row.

Leaf: SHA-256 (lower-case hex) over doc_id, source, lang, n_chars and text, each as UTF-8 length, ``:`` and value, or
``-`` for null. The leaves of a source stand in the order of their doc_id (then of the leaf itself). While more than one
node remains, every ``FAN`` consecutive ones become their digest; what remains is the source's subroot. The subroots, by
source, are hashed in the same way up to the root.

Rows are ranked by a range sort on source, doc_id and leaf, so no source has to fit into one task. Built levels are
saved as node rows: the digests of a node's children in one value, and the link to its parent (level, number, own slot).
A recursive query then climbs the links from every leaf: each step joins the parent's row, puts the own digest into its
slot, hashes, and appends the siblings. The leaves of one lowest run have the same way from there on, so they climb
in one row that carries a digest for each of them. All ways end in one root, so a node's row is repeated once per
``CLIMBERS`` rows beneath it, and no key of the join is hot.

Defined results: a null source is a source of its own and the first; a null doc_id stands before the others; rows that
repeat a doc_id are leaves of their own, and wholly equal rows have equal leaves, whose places are interchangeable. A
null text is ``-`` and cannot be tampered with; an empty one is ``0:``. An empty table has no rows and no root. Columns
besides the five are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import saved

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Climbing rows that meet in one key of the join.
CLIMBERS = 4096
#: Levels of a source's tree count from 1, those of the tree over the sources from here.
TOP = 100
#: Bytes of a digest, and no bytes.
WIDE, NONE = 32, "X''"


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """SHA-256 of a row's five fields (binary); ``replaced`` gives other values for some of them."""
    return F.unhex(F.sha2(F.concat(*[_field(replaced.get(c, F.col(c))) for c in FIELDS]), 256))


def _digest(children: Column) -> Column:
    """Digest over the hex text of the children's digests, which stand in one value."""
    return F.unhex(F.sha2(F.lower(F.hex(children)), 256))


def numbered(df: DataFrame, order: list, purpose: str) -> DataFrame:
    """The rows with ``at``, their place from 0 in the order of the columns ``order`` (nulls first), saved."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = saved(ranged.withColumn("id", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("id", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"), F.min("id").alias("first_id"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", (before - F.col("first_id")).alias("shift"))  # one row for each partition of the sort
    placed = rows.join(F.broadcast(starts), part == F.col("part")).withColumn("at", F.col("id") + F.col("shift"))
    return placed.drop("id", "shift")


def leaves(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """doc_id, leaf, folded (the leaf of the tampered text; without ``tampered_text`` the leaf itself), at (place in the
    order of source and doc_id), first (least place of the source) and n (leaves of the source)."""
    rows = docs.select(*[F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS])
    folded = leaf_digest() if tampered_text is None else leaf_digest(text=tampered_text)
    changed = F.lit(False) if tampered_text is None else ~tampered_text.eqNullSafe(F.col("text"))
    hashed = rows.select("doc_id", "source", leaf_digest().alias("leaf"), F.when(changed, folded).alias("changed"))
    hashed = hashed.withColumn("row", F.monotonically_increasing_id())
    placed = numbered(saved(hashed, "leaves"), ["source", "doc_id", "leaf", "row"], "ranked-leaves")
    # A source's rows of one partition are counted first, so a large source is one row for each partition.
    pieces = placed.groupBy("part", "source").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy("source")
    pieces = pieces.select(F.col("part").alias("_part"), F.col("source").alias("_source"), F.min("first").over(whole).alias("first"), F.sum("n").over(whole).alias("n"))
    same = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    return placed.join(pieces, same).select("doc_id", "leaf", F.coalesce("changed", "leaf").alias("folded"), "at", "first", "n")


def _linked(rows: DataFrame, level: int) -> DataFrame:
    """Adds the link to the parent: up_level, up, slot, copies (of the parent's row); nulls where none is left."""
    inner = F.col("n") > 1
    place = F.col("node") - F.col("first")
    up = (F.col("first") + F.floor(place / FAN)).cast("long")
    rows = rows.withColumn("level", F.lit(level)).withColumn("up", F.when(inner, up))
    beneath = F.sum("climbers").over(Window.partitionBy("first", "up"))  # FAN rows at most
    return rows.withColumns(
        {
            "up_level": F.when(inner, F.lit(level + 1)),
            "slot": F.when(inner, (place % FAN).cast("int")),
            "copies": F.when(inner, F.ceil(beneath / CLIMBERS).cast("long")),
        }
    )


def _levels(rows: DataFrame, base: int) -> list[DataFrame]:
    """Saved levels from ``rows`` (first, n, node, digest, climbers, kids and others) up to single nodes; a level has
    a FAN-th of the rows of the one below."""
    built = []
    while True:
        level = base + len(built)
        built.append(saved(_linked(rows, level), f"level-{level}"))
        inner = built[-1].filter("n > 1")
        if inner.isEmpty():
            return built
        kids = F.expr("array_sort(collect_list(struct(slot, digest)))")
        groups = inner.groupBy("first", "n", "up").agg(kids.alias("run"), F.sum("climbers").alias("climbers"))
        groups = groups.withColumn("kids", F.expr("aggregate(run, X'', (a, k) -> concat(a, k.digest))"))
        above = F.ceil(F.col("n") / FAN).cast("long")
        rows = groups.select("first", above.alias("n"), F.col("up").alias("node"), _digest(F.col("kids")).alias("digest"), "climbers", "kids")


def _runs(found: DataFrame) -> DataFrame:
    """The lowest runs: members (doc_id, leaf, folded) of FAN leaves at most, and their digest. A lone leaf of a source is its own
    digest."""
    run = (F.col("first") + F.floor((F.col("at") - F.col("first")) / FAN)).cast("long")
    members = F.expr("array_sort(collect_list(struct(at, doc_id, leaf, folded)))")
    runs = found.groupBy("first", "n", run.alias("node")).agg(members.alias("members"))
    runs = runs.withColumn("kids", F.expr("aggregate(members, X'', (a, m) -> concat(a, m.leaf))"))
    lone = F.col("n") == 1
    digest = F.when(lone, F.col("kids")).otherwise(_digest(F.col("kids")))
    return runs.select("first", F.ceil(F.col("n") / FAN).cast("long").alias("n"), "node", digest.alias("digest"), F.lit(1).cast("long").alias("climbers"), "kids", lone.alias("lone"), "members")


def _with_slot(children: str, slot: str, own: str) -> str:
    """Children's digests with another one in a slot."""
    return f"concat(substring({children}, 1, {WIDE} * {slot}), {own}, substring({children}, {WIDE} * {slot} + {WIDE + 1}))"


def _hash_sql(children: str) -> str:
    return f"unhex(sha2(lower(hex({children})), 256))"


CLIMB = f"""
    WITH RECURSIVE climb AS (
        SELECT node, folded, up_level, up, slot, pmod(node, copies) AS copy, X'' AS above, CAST(NULL AS BINARY) AS subroot FROM {{starts}}
        UNION ALL
        SELECT c.node, transform(c.folded, own -> {_hash_sql(_with_slot("p.kids", "c.slot", "own"))}),
               p.up_level, p.up, p.slot, pmod(c.node, p.copies),
               concat(c.above, {_with_slot("p.kids", "c.slot", NONE)}),
               CASE WHEN c.up_level = {TOP + 1} THEN substring(p.kids, {WIDE} * c.slot + 1, {WIDE}) ELSE c.subroot END
        FROM climb c JOIN {{nodes}} p ON c.up_level = p.level AND c.up = p.node AND c.copy = p.copy)
    SELECT node, folded, above, subroot FROM climb WHERE up_level IS NULL"""


def _climbed(spark: SparkSession, starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, folded (root digests), above (siblings beyond the lowest run), subroot: what arrives at the root, saved."""
    starts.createOrReplaceTempView("merkle_starts")
    nodes.createOrReplaceTempView("merkle_nodes")
    # The recursion returns every step of every leaf; its default limit of rows is far below a large table.
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return saved(spark.sql(CLIMB.format(starts="merkle_starts", nodes="merkle_nodes")), "climbed")
    finally:
        spark.conf.set(limit, before)
        spark.catalog.dropTempView("merkle_starts")
        spark.catalog.dropTempView("merkle_nodes")


def proofs(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (siblings, lower level first, in one value), folded_root and verified for each
    row of ``docs``; all digests are binary. ``tampered_text`` is the text as found when the proof is checked, by default the original."""
    spark = docs.sparkSession
    built = _levels(_runs(leaves(docs, tampered_text)), base=1)
    ends = [level.filter("n = 1").select("first", "digest", "climbers") for level in built]
    subroots = numbered(reduce(DataFrame.union, ends), ["first"], "subroots")
    sources = F.lit(subroots.count()).cast("long")
    top = _levels(subroots.select(F.lit(0).cast("long").alias("first"), sources.alias("n"), F.col("at").alias("node"), "digest", "climbers", F.lit(None).cast("binary").alias("kids"), F.col("first").alias("source_first")), base=TOP)
    # The last node of a source goes on to the tree over the sources.
    links = ["up_level", "up", "slot", "copies"]
    onward = top[0].select(F.col("source_first").alias("_first"), F.lit(1).cast("long").alias("_n"), *[F.col(c).alias(f"_{c}") for c in links])
    joined = [level.join(onward, (F.col("first") == F.col("_first")) & (F.col("n") == F.col("_n")), "left") for level in built]
    joined = [level.withColumns({c: F.coalesce(f"_{c}", c) for c in links}) for level in joined]
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("climbers") / CLIMBERS).cast("long") - 1))
    nodes = [level.select("level", "node", "kids", *links, copies.alias("copy")) for level in joined[1:] + top[1:]]
    none = joined[0].select("level", "node", "kids", *links, F.lit(0).cast("long").alias("copy")).limit(0)
    lowest = joined[0]
    changed = F.expr(f"transform(members, (m, i) -> CASE WHEN lone THEN m.folded ELSE {_hash_sql(_with_slot('kids', 'i', 'm.folded'))} END)")
    starts = lowest.select("node", changed.alias("folded"), *links)
    ended = _climbed(spark, starts, saved(reduce(DataFrame.union, nodes, none), "nodes"))
    # One digest: the root of the whole table.
    root = F.lit(row["digest"] if (row := top[-1].filter("n = 1").select("digest").first()) else None).cast("binary")
    own = built[0].select(F.col("node").alias("_node"), "members", "kids", "lone")
    rows = ended.join(own, F.col("node") == F.col("_node")).select("above", "subroot", "kids", "folded", F.posexplode("members").alias("i", "m"))
    siblings = F.expr(f"concat({_with_slot('kids', 'i', NONE)}, above)")
    ended_in = F.expr("folded[i]")
    return rows.select(
        F.col("m.doc_id").alias("doc_id"),
        F.col("m.leaf").alias("leaf"),
        F.coalesce("subroot", root).alias("subroot"),
        root.alias("root"),
        siblings.alias("proof"),
        ended_in.alias("folded_root"),
        (ended_in == root).alias("verified"),
    )
