"""Exact duplicates by deterministic block naming (DataFrame operations only).

Texts are cut into blocks of ``block_bytes`` bytes. Distinct blocks are sorted
and numbered, which gives each an integer name; then the names of adjacent
pairs are named in the same way, level by level, until every document has one
name. Documents of the same length go through the same levels, so (length,
name) is equal exactly when the texts are: names come from sorted distinct
content, not from a hash. A 64-bit hash only leads the sort and carries the
name back to the document; if two different blocks share one (checked), the
content itself is used as the key instead.

Blocks are made distinct before they are shuffled, so a block that a third of
all rows hold costs one row per task. Tables that are joined back are written
first, so that the runtime can split a hot name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize

BLOCK_BYTES = 4096


def _block_list(text: Column, block_bytes: int, key) -> Column:
    last = F.greatest(F.octet_length(text) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), (last / block_bytes).cast("int")),
                       lambda i: key(F.substring(text, i * block_bytes + 1, F.lit(block_bytes))))


def _numbered(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows of ``keys`` with an integer name each, in sorted order in each partition."""
    return (pairs.select(*keys).distinct().sortWithinPartitions(*keys)
            .select(*keys, F.monotonically_increasing_id().alias("name")))


def name_documents(docs: DataFrame, text_col: str = "text", carry: list[Column] | None = None,
                   block_bytes: int = BLOCK_BYTES, key=F.xxhash64) -> DataFrame:
    """One row per input row: ``rid, n_bytes, name`` and the ``carry`` columns.

    ``(n_bytes, name)`` is equal exactly for equal texts; null counts as empty.
    An empty table gives an empty result.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = materialize(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.octet_length(text).cast("long").alias("n_bytes"),
        _block_list(text, block_bytes, key).alias("keys"), *(carry or [])), "naming-rows")
    content = docs.select(F.explode(_block_list(text, block_bytes, lambda b: b)).alias("content"))
    names = materialize(
        content.select(key("content").alias("key"), "content").distinct()
        .sortWithinPartitions("key", "content")
        .select("key", F.monotonically_increasing_id().alias("name")), "naming-blocks")
    if not names.groupBy("key").count().filter("count > 1").isEmpty():
        return name_documents(docs, text_col, carry, block_bytes, key=lambda b: F.col(b) if isinstance(b, str) else b)
    level = materialize(rows.select("rid", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
                        .join(names, "key").select("rid", "n", "pos", "name"), "naming-level")
    done = [level.filter("n = 1").select("rid", "name")]
    while True:
        pairs = (level.filter("n > 1").groupBy("rid", "n", F.expr("pos div 2").alias("pos"))
                 .agg(F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("l"),
                      F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("r")))
        pairs = materialize(pairs, "naming-pairs")
        if pairs.isEmpty():
            break
        names = materialize(_numbered(pairs, ["l", "r"]), "naming-names")
        level = materialize(pairs.join(names, ["l", "r"])
                            .select("rid", F.expr("cast((n + 1) div 2 as int)").alias("n"), "pos", "name"), "naming-level")
        done.append(level.filter("n = 1").select("rid", "name"))
    named = done[0]
    for d in done[1:]:
        named = named.unionAll(d)
    return rows.drop("keys").join(named, "rid")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, key=F.xxhash64) -> DataFrame:
    """``rid, doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Of equal texts the row with the largest id stays (null ids come last; of
    rows with the same id, one). Null texts equal empty ones. No rows in, no
    rows out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = materialize(name_documents(
        docs, text_col, [F.col(id_col).alias("doc_id"), F.sha2(F.encode(text, "UTF-8"), 256).alias("text_sha256")],
        block_bytes, key), "naming-documents")
    groups = materialize(
        named.groupBy("n_bytes", "name")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
             F.coalesce(F.max_by("rid", "doc_id"), F.max("rid")).alias("keep_rid"))
        .filter("group_size > 1"), "naming-groups")
    out = named.join(groups, ["n_bytes", "name"], "left")
    alone = F.col("group_size").isNull()
    return out.select("rid", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    held = "kept_row_id"
    while held in docs.columns:
        held += "_"
    copy = materialize(docs.withColumn(held, F.monotonically_increasing_id()), "naming-copy")
    marks = exact_duplicates(copy.select(F.struct(F.col(id_col), F.col(held)).alias("doc_id"),
                                         F.col(text_col).alias("text")))
    gone = marks.filter("not kept").select(F.col(f"doc_id.{held}").alias(held))
    return copy.join(gone, held, "left_anti").select(*docs.columns)
