"""Merkle manifest of a table: digests of rows, trees over them, and a recursive query that proves each row.

A leaf is the digest of a row's fields. Per language the leaves are ordered by
id and every two neighbours become their digest, the last one alone if it has
no neighbour, until one is left, the subroot. The subroots in order of language
make the root in the same way.

The built levels are stored as node rows. A row holds ``HEIGHT`` levels of one
``WIDTH``-wide part of a tree, one binary value of digests for each level, and links
to the row above it. The recursive query starts at all leaves and ascends one row
a step, appending the siblings it passes and folding the digest that is to be
checked, so trees of any practical size take a few steps and no step moves the
tree. Above the lowest row all leaves of a tree would meet at one key: leaves
belong to chunks of ``CHUNK``, and upper rows are stored for each chunk below them.

Leaves are numbered by a cluster-wide sort: places within sorted parts, and
one offset for each part and language.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from boardweave.llm.batches import written
from boardweave.llm.similar import few
from boardweave.plans.session import fresh_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 9  # levels of a stored row
WIDTH = 1 << HEIGHT
CHUNK = 1 << 16  # leaves that go through the same upper rows; no wider than two stored rows
FEW_ROWS = 1 << 11  # stored rows, 64 MB of digests, that are sent to every executor; more are dealt out by their key
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(fields: list[Column]) -> Column:
    """SHA-256, as bytes, of each field's number of UTF-8 bytes, a colon and the field, or of a hyphen for a null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined_digest(nodes: str) -> str:
    """SQL for the digest of the hexadecimal text of these bytes."""
    return f"unhex(sha2(lower(hex({nodes})), 256))"


def numbered(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """The rows with ``at``, their place within the group from 0 on in this order, and ``many``, the group's size.

    Rows equal in the order are dealt out by where they stand in the input.
    """
    # Numbers of the input break ties, so that even rows that are all alike are split.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(group), *order, F.col("tie")]
    placed = rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("spot"))
    placed = written(placed.drop("tie"), "sorted")
    each = placed.groupBy(F.col(group).alias("own"), F.col("part").alias("in")).agg(F.min("spot").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("own").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("own", "in", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("own")).alias("many"))
    each = few(written(each, "parts"))  # a row for each part and group
    found = placed.join(each, (F.col(group) == F.col("own")) & (F.col("part") == F.col("in")))
    return found.select(*[c for c in rows.columns if c != "tie"], (F.col("spot") - F.col("first") + F.col("before")).alias("at"), "many")


def _levels(count: str) -> Column:
    """How often a number of nodes is halved until one is left."""
    return F.when(F.col(count) > 1, F.length(F.bin(F.col(count) - 1))).otherwise(0).cast("int")


def _rows(nodes: DataFrame, step: int) -> DataFrame:
    """Stored rows (tree, no, height, levels, top, many, count) from nodes (tree, at, node, many); ``many`` leaves or subroots are below the tree."""
    nodes = nodes.select("tree", "many", F.expr(f"at div {WIDTH}").alias("no"), (F.col("at") % WIDTH).alias("place"), "node")
    held = nodes.groupBy("tree", "no").agg(F.max("many").alias("many"), F.sort_array(F.collect_list(F.struct("place", "node"))).alias("held"))  # WIDTH at most
    held = held.withColumn("count", F.ceil(F.col("many") / WIDTH**step).cast("long"))
    held = held.withColumn("height", F.least(F.lit(HEIGHT), _levels("count")))
    held = held.withColumn("lowest", F.expr("unhex(array_join(transform(held, x -> hex(x.node)), ''))"))
    pairs = "sequence(0, (octet_length(element_at(done, -1)) + 63) div 64 - 1)"
    above = f"unhex(array_join(transform({pairs}, i -> sha2(lower(hex(substring(element_at(done, -1), cast(64 * i + 1 as int), 64))), 256)), ''))"
    held = held.withColumn("levels", F.expr(
        f"aggregate(filter(sequence(1, {HEIGHT}), j -> j <= height), array(lowest), (done, j) -> array_append(done, {above}))"))
    return held.select("tree", "no", "height", "levels", F.expr("element_at(levels, -1)").alias("top"), "many", "count")


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored rows step by step, and (tree, node, many) of the roots."""
    steps, roots = [], []
    while True:
        rows = written(_rows(nodes, len(steps)), "rows")
        steps.append(rows)
        roots.append(rows.where(f"count <= {WIDTH}").select("tree", F.col("top").alias("node"), "many"))
        nodes = rows.where(f"count > {WIDTH}").select("tree", F.col("no").alias("at"), F.col("top").alias("node"), "many")
        if nodes.isEmpty():
            break
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return steps, found


def write_manifest(docs: DataFrame, folder: str, observed: dict[str, Column] | None = None) -> None:
    """Writes ``leaves`` and ``nodes`` below the folder.

    Leaves have the digest of a row and of the same row with the ``observed``
    columns in place of its own, which the climb is to check. Null ids come
    first; rows that share an id follow each other by digest; a null language is a tree of its own, before the others.
    """
    spark = docs.sparkSession
    own = [F.col(c) for c in FIELDS]
    seen = [(observed or {}).get(c, F.col(c)) for c in FIELDS]
    tree = F.coalesce(F.concat(F.lit("s"), F.col("lang").cast("string")), F.lit("n"))  # in order of language, null first
    rows = docs.select(tree.alias("name"), F.col("doc_id").cast("long").alias("doc_id"), digest(own).alias("leaf"), digest(seen).alias("seen"))
    rows = numbered(rows, "name", F.col("doc_id"), F.col("leaf"))
    trees = numbered(rows.groupBy("name").agg(F.lit(0).alias("all")), "all", F.col("name"))
    trees = written(trees.select(F.col("name").alias("of"), F.col("at").alias("tree")), "trees")
    leaves = rows.join(few(trees), F.col("name") == F.col("of")).select(
        "tree", "at", "doc_id", "leaf", F.when(F.col("seen") != F.col("leaf"), F.col("seen")).alias("seen"), "many")
    leaves.write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    steps, subroots = _tree(leaves.select("tree", "at", F.col("leaf").alias("node"), "many"))
    subroots = written(subroots, "subroots")
    tops = subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("at"), "node",
                           F.lit(subroots.count()).cast("long").alias("many"))
    upper, _ = _tree(tops)
    for step, found in enumerate(steps):
        below = WIDTH ** (step + 1)  # leaves below a row
        last = f"least(many, (no + 1) * {below}) - 1"
        part = found.withColumn("chunk", F.explode(F.expr(f"sequence(no * {below} div {CHUNK}, ({last}) div {CHUNK})")))
        top = F.col("count") <= WIDTH
        part = part.select(
            "tree", "chunk", F.lit(step).alias("step"), "no", "height", "levels", "top", top.alias("subroot"),
            F.when(top, F.expr(f"tree div {WIDTH}")).otherwise(F.expr(f"no div {WIDTH}")).alias("up"),
            F.when(top, F.col("tree") % WIDTH).otherwise(F.col("no") % WIDTH).alias("up_place"), F.lit(False).alias("root"))
        part.write.mode("append").parquet(f"{folder}/nodes")
    # The tree of subroots goes on above each language's own steps.
    size = subroots.select("tree", F.expr(f"(many - 1) div {CHUNK}").alias("last"), _steps("many").alias("own"))
    for step, found in enumerate(upper):
        below = WIDTH ** (step + 1)
        rows = found.select("no", "height", "levels", "top", "count")
        part = size.withColumn("of", F.expr(f"tree div {below}")).join(rows, F.col("of") == F.col("no"))
        part = part.withColumn("chunk", F.explode(F.expr("sequence(0L, last)")))
        part.select(
            "tree", "chunk", (F.col("own") + step).alias("step"), "no", "height", "levels", "top", F.lit(False).alias("subroot"),
            F.expr(f"no div {WIDTH}").alias("up"), (F.col("no") % WIDTH).alias("up_place"), (F.col("count") <= WIDTH).alias("root"),
        ).write.mode("append").parquet(f"{folder}/nodes")


def _steps(many: str) -> Column:
    """Stored rows from a leaf to the top of a tree of so many."""
    return F.greatest(F.lit(1), F.ceil(_levels(many) / HEIGHT)).cast("int")


def _climb(leaves: str, nodes: str, hint: str = "") -> str:
    """The recursive query over these views."""
    turns = f"filter(sequence(0, {HEIGHT - 1}), j -> j < n.height)"
    beside = "substring(element_at(n.levels, j + 1), cast(32 * (shiftright(c.place, j) ^ 1) + 1 as int), 32)"
    right = "(shiftright(c.place, j) & 1) = 1"
    folded = joined_digest(f"concat(if({right}, {beside}, X''), held, if({right}, X'', {beside}))")
    return f"""
        WITH RECURSIVE climb(doc_id, leaf, tree, chunk, step, no, place, folded, siblings, subroot, root) AS (
            SELECT doc_id, leaf, tree, at div {CHUNK}, 0, at div {WIDTH}, at % {WIDTH}, coalesce(seen, leaf), X'', X'', X'' FROM {leaves}
            UNION ALL
            SELECT {hint} c.doc_id, c.leaf, c.tree, c.chunk, if(n.root, -1, c.step + 1), n.up, n.up_place,
                   aggregate({turns}, c.folded, (held, j) -> {folded}),
                   concat(c.siblings, unhex(array_join(transform({turns}, j -> hex({beside})), ''))),
                   if(n.subroot, n.top, c.subroot), if(n.root, n.top, c.root)
            FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.chunk = n.chunk AND c.step = n.step AND c.no = n.no)
        SELECT doc_id, leaf, subroot, root, siblings, folded FROM climb WHERE step = -1"""


def climbed(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings, folded) of every leaf of a manifest, as bytes; siblings one after another from the leaf up."""
    names = [f"merkle_{what}_{uuid.uuid4().hex}" for what in ("leaves", "nodes")]
    for name, what in zip(names, ("leaves", "nodes"), strict=True):
        spark.read.parquet(f"{folder}/{what}").createOrReplaceTempView(name)
    hint = "/*+ BROADCAST(n) */" if spark.table(names[1]).count() <= FEW_ROWS else ""
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # a row for each leaf and step
    try:
        return written(spark.sql(_climb(*names, hint)), "climbed")
    finally:
        spark.conf.set(_ROW_LIMIT, before)
        for name in names:
            spark.catalog.dropTempView(name)


def proofs(docs: DataFrame, observed: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests in lower-case hexadecimal.

    An empty table has no rows. Columns other than ``FIELDS`` are not read.
    """
    spark = docs.sparkSession
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    folder = fresh_dir(spark, "manifest")
    write_manifest(docs, folder, observed)
    text = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return climbed(spark, folder).select(
        "doc_id", *text, F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def tampered_proofs(docs: DataFrame) -> DataFrame:
    """``proofs`` of rows of which every seventh, by the checksum of the id, has its ``n_chars`` raised by one."""
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return proofs(docs, {"n_chars": F.when(seventh, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


def oracle(levels: int = 24) -> str:
    """``tampered_proofs`` in SQL, for up to 2**levels rows of a language and as many languages."""

    def field(c: str) -> str:
        return f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"

    def tree(name: str, first: str) -> tuple[str, str]:
        """Nodes (name, level, pos, h) of trees as steps, and their union; a tree ends at the level with one node."""
        steps = [f"{name}0 AS ({first})"]
        for k in range(1, levels + 1):
            steps.append(f"""{name}{k} AS (SELECT lang, pos // 2 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, (max(many) + 1) // 2 AS many
                FROM {name}{k - 1} WHERE many > 1 GROUP BY lang, pos // 2)""")
        whole = " UNION ALL ".join(f"SELECT *, {k} AS level FROM {name}{k}" for k in range(levels + 1))
        return ",".join(steps), f"{name} AS MATERIALIZED ({whole})"

    own, all_own = tree("own", "SELECT lang, pos, h, many FROM leaves")
    top, all_top = tree("top", "SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS many FROM own WHERE many = 1")
    return f"""
        WITH RECURSIVE crc AS (
            SELECT doc_id, doc_id::VARCHAR AS s, 0 AS i, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT doc_id, s, i + 1, CASE WHEN c2 & 1 = 1 THEN xor(c2 >> 1, 3988292384) ELSE c2 >> 1 END
            FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, ascii(s[i // 8 + 1])::BIGINT) ELSE c END AS c2 FROM crc WHERE i < 8 * len(s))),
        checksum AS (SELECT doc_id, xor(c, 4294967295) % 7 = 0 AS seventh FROM crc WHERE i = 8 * len(s)),
        leaves AS MATERIALIZED (
            SELECT d.doc_id, lang, {leaf("n_chars")} AS h, CASE WHEN seventh THEN {leaf("n_chars + 1")} ELSE {leaf("n_chars")} END AS seen,
                   row_number() OVER (PARTITION BY lang ORDER BY d.doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS many
            FROM documents d LEFT JOIN checksum USING (doc_id)),
        {own}, {all_own}, {top}, {all_top},
        subroots AS MATERIALIZED (SELECT lang, h, (SELECT max(level) FROM own o WHERE o.lang IS NOT DISTINCT FROM w.lang) AS height,
                            row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM own w WHERE many = 1),
        last AS (SELECT h AS root, level AS above FROM top WHERE many = 1),
        climb AS (
            SELECT l.doc_id, l.h AS leaf, l.lang, l.pos, s.h AS subroot, s.rank, s.height, 0 AS step, l.seen AS folded, '' AS proof FROM leaves l
            JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
            UNION ALL
            SELECT c.doc_id, c.leaf, c.lang, c.pos, c.subroot, c.rank, c.height, c.step + 1,
                   sha256(CASE WHEN c.spot % 2 = 1 THEN coalesce(c.beside, '') || c.folded ELSE c.folded || coalesce(c.beside, '') END), c.proof || coalesce(c.beside, '')
            FROM (SELECT x.*, CASE WHEN step < height THEN x.pos >> step ELSE rank >> (step - height) END AS spot, coalesce(o.h, t.h) AS beside
                  FROM climb x, last
                  LEFT JOIN own o ON step < height AND o.lang IS NOT DISTINCT FROM x.lang AND o.level = step AND o.pos = xor(x.pos >> step, 1)
                  LEFT JOIN top t ON step >= x.height AND t.level = step - x.height AND t.pos = xor(x.rank >> (step - x.height)::INT, 1)
                  WHERE step < x.height + last.above) c)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM climb, last WHERE step = height + above"""
