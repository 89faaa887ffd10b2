"""Merkle manifest of a table by a butterfly exchange.

Leaves are ordered within their tree and dealt to aligned chunks of
``FANOUT ** LEVELS`` places, each of which one task hashes up to its subtree
root. Then aligned groups of ``FANOUT`` chunks swap roots, round by round:
in round ``r`` a chunk meets those whose number differs from its own in the
``r``-th digit to the base ``FANOUT`` only, so the ancestor that eight
chunks share is hashed by each of them again, and after the last round
every chunk holds the root and the siblings of all its ancestors. No way
down follows: a chunk's task adds its own lower levels and proves its leaves.
In a last run with fewer chunks below a sibling, those that are there serve
the others in turn.

The subroots of all trees are the leaves of one more tree, of the same kind.

Places come from a range sort and one count per sorted partition and tree:
no window over a tree, however many rows it has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeforge.llm.common import ascii_lower, documents, materialize

FANOUT, LEVELS = 8, 4
#: What a run holds beside a node: the node's place in it, and the others.
STEP = "struct<place:int,others:array<string>>"


def field(c: Column) -> Column:
    """A value in a hash's input: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``pos``, each row's place in its ``tree`` by ``order`` (nulls first), and ``n``, the tree's size."""
    keys = [F.col(c).asc_nulls_first() for c in ["tree", *order]]
    ordered = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the number of the partition, and below that the row's place in it
    ordered = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    runs = ordered.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("rows").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(by_tree).alias("n"))
    out = ordered.withColumn("part", part).join(runs, ["tree", "part"])
    return out.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "shift", "part")


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def lower_levels(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """A chunk's nodes level by level, up to its subtree root (a smaller tree's root)."""
    out = [nodes]
    for _ in range(levels):
        if n <= 1:
            break
        n = -(-n // FANOUT)
        last = out[-1]
        out.append([_hash(last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return out


def chunk_of(pos: Column, levels: int) -> Column:
    return F.floor(pos / FANOUT**levels).cast("long")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Table]]:
    """The rows of each chunk; a chunk is a run of rows with the same tree and number."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        tree, chunk = batch.column("tree"), batch.column("chunk").to_numpy()
        same = np.array(tree.to_pylist(), object)
        ends = np.flatnonzero((chunk[1:] != chunk[:-1]) | (same[1:] != same[:-1])) + 1
        for a, b in zip([0, *ends], [*ends, len(chunk)]):
            if a == b:
                continue
            now = (same[a], int(chunk[a]))
            if held and now != last:
                yield {"tree": last[0], "chunk": last[1]}, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield {"tree": last[0], "chunk": last[1]}, pa.Table.from_batches(held)


def by_chunk(df: DataFrame) -> DataFrame:
    return df.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")


def chunk_roots(leaves: DataFrame, levels: int) -> DataFrame:
    """``(tree, chunk, chunks, node)``: the subtree root of every chunk of the ``placed`` leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in _chunks(batches):
            n = rows.column("n")[0].as_py()
            node = lower_levels(rows.column("leaf").to_pylist(), n, levels)[-1][0]
            yield pa.RecordBatch.from_pylist([{**at, "chunks": -(-n // FANOUT**levels), "node": node}], schema=schema)

    schema = pa.schema([("tree", pa.string()), ("chunk", pa.int64()), ("chunks", pa.int64()), ("node", pa.string())])
    rows = leaves.select("tree", chunk_of(F.col("pos"), levels).alias("chunk"), "pos", "n", "leaf")
    return by_chunk(rows).mapInArrow(run, "tree string, chunk long, chunks long, node string")


def butterfly(chunks: DataFrame) -> DataFrame:
    """``(tree, chunk, root, upper)``: the tree's root and the runs on the way to it, from the chunk's own root up.

    One round per level; a round moves one digest per chunk and sibling.
    """
    state = materialize(chunks.withColumn("upper", F.array().cast(f"array<{STEP}>")), "chunks")
    most, width = state.agg(F.max("chunks")).first()[0] or 0, 1
    while width < most:
        # nodes of this level stand for ``width`` chunks each
        own = F.floor(F.col("chunk") / width)
        nodes = F.ceil(F.col("chunks") / width)
        first = F.floor(own / FANOUT) * FANOUT
        sibling = F.explode(F.sequence(first, F.least(first + FANOUT, nodes) - 1))
        asks = state.where(nodes > 1).select("tree", "chunk", "chunks", sibling.alias("sibling"))
        size = F.least((F.col("sibling") + 1) * width, F.col("chunks")) - F.col("sibling") * width
        asks = asks.withColumn("partner", F.col("sibling") * width + F.col("chunk") % width % size).drop("chunks")
        roots = state.select("tree", F.col("chunk").alias("partner"), "node")
        run = F.sort_array(F.collect_list(F.struct("sibling", "node")))  # a run's nodes: eight at most
        runs = asks.join(roots, ["tree", "partner"]).groupBy("tree", "chunk").agg(run.alias("run"))
        met = state.join(runs, ["tree", "chunk"], "left")
        others = F.transform(F.filter("run", lambda x: x["sibling"] != own), lambda x: x["node"])
        step = F.struct((own % FANOUT).cast("int").alias("place"), others.alias("others"))
        parent = F.sha2(F.concat_ws("", F.transform("run", lambda x: x["node"])), 256)
        alone = F.col("run").isNull()  # the tree has its root
        state = met.select(
            "tree", "chunk", "chunks",
            F.when(alone, F.col("node")).otherwise(parent).alias("node"),
            F.when(alone, F.col("upper")).otherwise(F.concat("upper", F.array(step).cast(f"array<{STEP}>"))).alias("upper"),
        )
        state = materialize(state, "round")
        width *= FANOUT
    return state.select("tree", "chunk", F.col("node").alias("root"), "upper")


def climb(node: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a node leads to with the others of each run."""
    for place, others in steps:
        node = _hash([*others[:place], node, *others[place:]])
    return node


def prove(leaves: DataFrame, uppers: DataFrame, levels: int, schema: str, answer) -> DataFrame:
    """``answer(row, steps, subroot, root)`` of every leaf, its chunk's upper runs in hand.

    ``uppers``: ``tree, chunk, upper, subroot, root``, one row per chunk. A
    chunk's rows and its upper runs meet in one task, the runs first.
    """
    chunk = chunk_of(F.col("pos"), levels).alias("chunk")
    rows = leaves.select("*", chunk, F.lit(None).cast(f"array<{STEP}>").alias("upper"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
    head = uppers.select("tree", "chunk", F.lit(-1).cast("long").alias("pos"), "upper", "subroot", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _chunks(batches):
            first, *rest = table.to_pylist()
            upper = [(s["place"], s["others"]) for s in first["upper"]]
            nodes = lower_levels([r["leaf"] for r in rest], rest[0]["n"], levels) if rest else [[]]
            out = []
            for i, row in enumerate(rest):
                steps = []
                for level in nodes[:-1]:
                    begin = i - i % FANOUT
                    steps.append((i - begin, level[begin:i] + level[i + 1 : begin + FANOUT]))
                    i //= FANOUT
                out.append(answer(row, steps + upper, first["subroot"], first["root"]))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    both = by_chunk(rows.unionByName(head, allowMissingColumns=True))
    return both.mapInArrow(run, schema)


def manifest(df: DataFrame, leaf: Column, tampered: Column, tree_col: str = "lang", id_col: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A tree per value of ``tree_col`` (null is one too, and the first one),
    its leaves by rising ``id_col``; rows with the same id, or none (these
    come first), by their hashes. Runs of eight are hashed until one node is
    left; the trees' roots, by their names' bytes, are hashed in the same
    way. ``proof_sha256`` hashes the others of a leaf's runs up to the root.
    ``folded_root`` is worked out from ``tampered`` and those others. A lone
    leaf is its tree's root, a lone tree's root the table's. An empty table
    gives an empty result; columns that the leaves do not name are ignored.
    """
    # by name, null first: an empty string comes before every marked name
    tree = F.when(F.col(tree_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree_col).cast("string")))
    leaves = materialize(df.select(tree.alias("tree"), F.col(id_col).alias("doc_id"), leaf.alias("leaf"), tampered.alias("tampered")), "leaves")
    leaves = materialize(placed(leaves, ["doc_id", "leaf"]), "placed")
    chunks = butterfly(chunk_roots(leaves, levels))

    trees = chunks.where("chunk = 0").select(F.lit("trees").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    trees = materialize(placed(trees, ["name"]), "trees")
    top = butterfly(chunk_roots(trees, levels)).withColumnRenamed("root", "subroot").withColumn("root", F.col("subroot"))
    above = prove(trees, top, levels, f"tree string, above array<{STEP}>, root string",
                  lambda row, steps, _, root: {"tree": row["name"], "above": [{"place": p, "others": o} for p, o in steps], "root": root})
    uppers = chunks.withColumnRenamed("root", "subroot").join(above, "tree")
    uppers = materialize(uppers.select("tree", "chunk", F.concat("upper", "above").alias("upper"), "subroot", "root"), "uppers")

    def answer(row: dict, steps: list, subroot: str, root: str) -> dict:
        folded = climb(row["tampered"], steps)
        proof = _hash([h for _, others in steps for h in others])
        return {"doc_id": row["doc_id"], "leaf": row["leaf"], "subroot": subroot, "root": root,
                "proof_sha256": proof, "folded_root": folded, "verified": folded == root}

    schema = f"doc_id {dict(leaves.dtypes)['doc_id']}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return prove(leaves, uppers, levels, schema, answer)


def document_leaves() -> tuple[Column, Column]:
    """The leaf of a document, and the one after tampering."""

    def of(text: Column) -> Column:
        return leaf_hash(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)

    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return of(F.col("text")), F.when(chosen, of(ascii_lower(F.col("text")))).otherwise(of(F.col("text")))


def query(spark, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir), *document_leaves())
