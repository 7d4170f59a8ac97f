"""Merkle manifests of tables: trees of digests whose parents keep the hash state before each child.

Leaves of one tree stand in order, and 16 consecutive nodes make a parent: the SHA-256 of their digests as text. A parent keeps
the state before each of its children, so that a changed leaf is folded to the root from the
state of its slot on, with itself and its right siblings alone; left siblings are needed for proofs only.
Roots of trees are the leaves of one more tree, whose root stands for the whole table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from lithos.llm._order import placed
from lithos.llm._sha import START, finished, hex_block, resumed
from lithos.llm._spark import Scratch
from lithos.llm._text import text_slices

FAN_OUT = 16
#: A node and what came down to it.
_NODE = "tree <=> _tree AND place = _place"


def _written(value: object) -> bytes:
    if value is None:
        return b"-"
    text = value.encode() if isinstance(value, str) else value if isinstance(value, bytes) else str(value).encode()
    return b"%d:" % len(text) + text


def leaf_digests(rows: DataFrame, fields: Sequence[str], *, tree: str, order: str, changed: tuple[Column, dict[str, Column]] | None = None) -> DataFrame:
    """``tree, id, digest, changed``: the SHA-256 of each row's ``fields``, each ``-`` if null, else its UTF-8 length, ``:`` and value.

    ``changed`` is a condition and new values of some fields; where it holds, ``changed`` is the digest of
    the row with these, else that of the row. Repeated rows give a row each, an empty table none; other columns are ignored.
    """
    when, new = changed or (F.lit(False), {})
    given = [F.col(f"`{f}`").alias(f"f{k}") for k, f in enumerate(fields)]
    instead = [F.when(when, new[f]).alias(f"n{k}") for k, f in enumerate(fields) if f in new]
    told = [k for k, f in enumerate(fields) if f in new]
    chosen = rows.select(F.col(f"`{tree}`").cast("string").alias("tree"), F.col(f"`{order}`").alias("id"), F.coalesce(when, F.lit(False)).alias("when"), *given, *instead)
    long = "f" + str(list(fields).index("text")) if "text" in fields else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, long) if long else [batch]:
                columns = [part.column(f"f{k}").to_pylist() for k in range(len(fields))]
                other = {k: part.column(f"n{k}").to_pylist() for k in told}
                digests, news = [], []
                for i, use in enumerate(part.column("when").to_pylist()):
                    pieces = [_written(c[i]) for c in columns]
                    digests.append(hashlib.sha256(b"".join(pieces)).digest())
                    for k in told if use else ():
                        pieces[k] = _written(other[k][i])
                    news.append(hashlib.sha256(b"".join(pieces)).digest() if use else digests[-1])
                yield pa.RecordBatch.from_arrays([part.column("tree"), part.column("id"), pa.array(digests, pa.binary()), pa.array(news, pa.binary())], ["tree", "id", "digest", "changed"])

    schema = StructType([StructField("tree", StringType()), StructField("id", rows.schema[order].dataType)])
    return chosen.mapInArrow(run, schema.add("digest", "binary").add("changed", "binary"))


@dataclass
class Manifest:
    """The levels of all trees from the leaves' parents up, and those of the tree over their roots.

    Each level is a written table of parents: ``tree, place, members`` (nodes that its tree has on this level),
    ``kids`` (``at, digest, changed, id``), ``digest`` and ``states`` (32 bytes before each kid). A tree that has
    come down to one node is handed up as it is, its ``states`` null.
    """

    levels: list[DataFrame]
    top: list[DataFrame]


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 32)


def _parents(kids: list[list[bytes]]) -> tuple[list[bytes], list[bytes]]:
    """Digest and states of each run of children."""
    many = np.array([len(k) for k in kids], np.int64)
    first = np.cumsum(many) - many
    blocks = hex_block(_matrix([d for k in kids for d in k]))
    state = np.repeat(START[None, :], len(kids), axis=0)
    states = np.empty((len(blocks), 8), np.uint32)
    for j in range(int(many.max(initial=0))):
        here = np.flatnonzero(many > j)
        states[first[here] + j] = state[here]
        state[here] = resumed(state[here], blocks[first[here] + j])
    digests, kept = finished(state, many).tobytes(), states.astype(">u4").tobytes()
    return [digests[32 * i : 32 * i + 32] for i in range(len(kids))], [kept[32 * a : 32 * (a + n)] for a, n in zip(first.tolist(), many.tolist(), strict=True)]


def _level(nodes: DataFrame) -> DataFrame:
    key = [F.col("tree"), F.floor(F.col("place") / FAN_OUT).alias("place"), F.when(F.col("members") == 1, 1).otherwise(F.ceil(F.col("members") / FAN_OUT)).alias("members"), (F.col("members") == 1).alias("alone")]
    runs = nodes.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), "digest", "changed", "id"))).alias("kids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("kids").flatten().field("digest").to_pylist()
            off = np.concatenate([[0], np.cumsum(batch.column("kids").value_lengths().to_numpy())]).tolist()
            kids = [digests[a:b] for a, b in zip(off, off[1:], strict=False)]
            made, states = _parents(kids)
            alone = batch.column("alone").to_pylist()
            above = pa.array([k[0] if one else d for k, d, one in zip(kids, made, alone, strict=True)], pa.binary())
            kept = pa.array([None if one else s for s, one in zip(states, alone, strict=True)], pa.binary())
            held = [batch.column(c) for c in ("tree", "place", "members", "kids")]
            yield pa.RecordBatch.from_arrays([*held, above, kept], ["tree", "place", "members", "kids", "digest", "states"])

    schema = StructType([f for f in runs.schema.fields if f.name != "alone"]).add("digest", "binary").add("states", "binary")
    return runs.mapInArrow(run, schema)


def _grown(leaves: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Levels until every tree has one node, at least one; as many jobs as the largest tree has levels."""
    levels: list[DataFrame] = []
    nodes = leaves
    while True:
        levels.append(scratch.write(_level(nodes), f"{name}-{len(levels) + 1}"))
        if (levels[-1].agg(F.max("members")).first()[0] or 1) == 1:
            return levels
        nodes = levels[-1].select("tree", "place", "members", "digest", F.lit(None).cast("binary").alias("changed"), F.lit(None).cast(leaves.schema["id"].dataType).alias("id"))


def build_manifest(leaves: DataFrame, scratch: Scratch) -> Manifest:
    """Trees over ``leaves`` (``tree, id, digest, changed``) in ascending ``id``, and the tree of their roots in ascending ``tree``; nulls first.

    Leaves of equal tree and id stand by their digests. A run never holds more than 16 nodes, so a tree with
    most leaves is as parallel as many trees. An empty table has empty levels.
    """
    held = scratch.write(leaves, "leaves")
    levels = _grown(placed(held, ["tree"], ["id", "digest", "changed"], scratch), scratch, "level")
    roots = scratch.write(levels[-1].select("tree", "digest"), "subroots")
    named = placed(roots, [], ["tree"], scratch).select(F.lit("").alias("tree"), "place", "members", "digest", F.lit(None).cast("binary").alias("changed"), F.col("tree").alias("id"))
    return Manifest(levels, _grown(named, scratch, "top"))


def _step(states: bytes, digests: list[bytes], slot: int) -> bytes:
    """What folding over one parent needs: the slot, the state before it, and its siblings on the left and on the right."""
    return bytes([slot]) + states[32 * slot : 32 * slot + 32] + b"".join(digests[:slot]) + b"".join(digests[slot + 1 :])


def _paths(level: DataFrame, above: DataFrame, kept: list[str]) -> DataFrame:
    """Of each child of ``level``: its ``tree, place`` and id, and ``path``, its own step before those of its parent."""
    rows = level.join(above, F.expr(_NODE)).select("tree", "kids", "states", "path", *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent, at, ids, paths = [], [], [], []
            for i, (kids, states, path) in enumerate(zip(batch.column("kids").to_pylist(), batch.column("states").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                digests = [k["digest"] for k in kids]
                for slot, kid in enumerate(kids):
                    parent.append(i)
                    at.append(kid["at"])
                    ids.append(kid["id"])
                    paths.append(path if states is None else [_step(states, digests, slot), *path])
            taken = pa.RecordBatch.from_arrays([batch.column(c) for c in ("tree", *kept)], ["tree", *kept]).take(pa.array(parent, pa.int64()))
            names = batch.column("kids").flatten().field("id").type
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(at, pa.int64()), pa.array(ids, names), pa.array(paths, pa.list_(pa.binary()))], ["tree", *kept, "at", "id", "path"])

    id_type = level.schema["kids"].dataType.elementType["id"].dataType
    schema = StructType([rows.schema["tree"], *[rows.schema[k] for k in kept], StructField("at", LongType()), StructField("id", id_type)]).add("path", ArrayType(BinaryType()))
    return rows.mapInArrow(run, schema)


def _folded(nodes: np.ndarray, steps: list[bytes]) -> np.ndarray:
    """The parents' digests with ``nodes`` in the place of the children that ``steps`` lead over."""
    slots = np.array([s[0] for s in steps], np.int64)
    state = np.frombuffer(b"".join([s[1:33] for s in steps]), ">u4").reshape(-1, 8).astype(np.uint32)
    right = _matrix([s[33 + 32 * s[0] :] for s in steps])
    many = np.array([(len(s) - 33) // 32 for s in steps], np.int64) - slots
    first = np.cumsum(many) - many
    state = resumed(state, hex_block(nodes))
    blocks = hex_block(right)
    for j in range(int(many.max(initial=0))):
        here = np.flatnonzero(many > j)
        state[here] = resumed(state[here], blocks[first[here] + j])
    return finished(state, slots + 1 + many)


def _fold_batch(kids: list[list[dict]], states: list[bytes | None], paths: list[list[bytes]]) -> tuple[list[int], list[str], list[bytes]]:
    """Of every leaf: its parent's row, the digest of its proof, and the root that its ``changed`` folds to."""
    parent, steps, height = [], [], []
    proofs: list[str] = []
    for i, (run, kept, path) in enumerate(zip(kids, states, paths, strict=True)):
        digests = [k["digest"] for k in run]
        names = [d.hex() for d in digests]
        above = "".join(s[33:].hex() for s in path)
        for slot in range(len(run)):
            parent.append(i)
            own = [] if kept is None else [_step(kept, digests, slot)]
            steps.append(own + path)
            height.append(len(steps[-1]))
            beside = "" if kept is None else "".join(names[:slot]) + "".join(names[slot + 1 :])
            proofs.append(hashlib.sha256((beside + above).encode()).hexdigest())
    nodes = _matrix([k["changed"] for run in kids for k in run]).copy()
    tall = np.array(height, np.int64)
    for level in range(int(tall.max(initial=0))):
        here = np.flatnonzero(tall > level)
        nodes[here] = _folded(nodes[here], [steps[i][level] for i in here.tolist()])
    return parent, proofs, [n.tobytes() for n in nodes]


def verify_leaves(manifest: Manifest) -> DataFrame:
    """``id, tree, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf, digests as hexadecimal text.

    Paths go down level by level: a parent hands each child one step more, so a row never holds more than a path, and leaves get
    theirs inside the run of 16 they stand in. ``proof_sha256`` is the digest of all siblings on the way, left to right and level by level; ``folded_root`` is
    what ``changed`` comes to when each parent's state is resumed; ``verified`` whether it is the root.
    """
    whole = manifest.top[-1].select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.array().cast("array<binary>").alias("path"), F.hex("digest").alias("root"))
    for level in reversed(manifest.top):
        below = _paths(level, whole, ["root"])
        whole = below.select(F.col("tree").alias("_tree"), F.col("at").alias("_place"), F.col("id"), "path", "root")
    roots = manifest.levels[-1].select(F.col("tree").alias("name"), F.hex("digest").alias("subroot"))
    above = whole.join(roots, F.col("id").eqNullSafe(F.col("name"))).select(F.col("name").alias("_tree"), F.lit(0).cast("long").alias("_place"), "path", "root", "subroot")
    for level in reversed(manifest.levels[1:]):
        below = _paths(level, above, ["root", "subroot"])
        above = below.select(F.col("tree").alias("_tree"), F.col("at").alias("_place"), "path", "root", "subroot")
    last = manifest.levels[0]
    rows = last.join(above, F.expr(_NODE)).select("tree", "kids", "states", "path", "root", "subroot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                held = part.column("kids").flatten()
                parent, proofs, folded = _fold_batch(part.column("kids").to_pylist(), part.column("states").to_pylist(), part.column("path").to_pylist())
                shared = pa.RecordBatch.from_arrays([part.column(c) for c in ("tree", "root", "subroot")], ["tree", "root", "subroot"]).take(pa.array(parent, pa.int64()))
                yield pa.RecordBatch.from_arrays([*shared.columns, held.field("id"), held.field("digest"), pa.array(proofs), pa.array(folded, pa.binary())], ["tree", "root", "subroot", "id", "leaf", "proof_sha256", "folded"])

    id_type = last.schema["kids"].dataType.elementType["id"].dataType
    schema = StructType([StructField("tree", StringType()), StructField("root", StringType()), StructField("subroot", StringType()), StructField("id", id_type)])
    found = rows.mapInArrow(run, schema.add("leaf", "binary").add("proof_sha256", "string").add("folded", "binary"))
    text = {"leaf": F.lower(F.hex("leaf")), "subroot": F.lower("subroot"), "root": F.lower("root"), "folded_root": F.lower(F.hex("folded"))}
    return found.withColumns(text).select("id", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def merkle_proofs(leaves: DataFrame) -> DataFrame:
    """``verify_leaves`` of the manifest over ``leaves``, whose tables are deleted once the result is written."""
    scratch = Scratch(leaves.sparkSession)
    return scratch.last(verify_leaves(build_manifest(leaves, scratch)), "proofs")
