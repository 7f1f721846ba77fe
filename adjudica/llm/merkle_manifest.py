"""Merkle manifest of a data set: a tree for each group, a tree of the groups' roots above, and a proof for each row.

1. Leaves. A row's leaf is the SHA-256 of its fields, each written with its length, so no two rows write the same bytes.
2. Bitmaps. Each group's ids become a bitmap of 64-bit words, of which only those with a bit are stored; words merge by
   bitwise or, so a group or id with very many rows is combined before it is moved. A directory of counts is laid over
   the words, 1024 children to a parent, with as many levels as the ids' range needs: what a word has before it is the sum
   over its levels of its earlier siblings' counts, so no window ever holds more than 1024 rows.
3. Ranks. A leaf's coordinate is its word's count before it plus the bits below its own (plus the further rows of
   repeated ids below, which the word lists). Leaves themselves are never sorted. Only rows of one id are ordered, by leaf.
4. Slot arrays. A block of SPAN consecutive leaves is one keyed array that a task reduces by several levels at once; the
   blocks' nodes are the slots of the next round, until each tree is one node. A block's size doesn't depend on its
   group's, so a group with a third of all rows is just many blocks.
5. Proofs go down the same blocks: each round hands a block the path above it, and a leaf's proof is its own block's
   levels and that path, so no path is moved for a leaf, only for a block.

Defined cases: a null field is written as ``-``; a null group is a group of its own and the first one; a null id comes
before all others; rows of equal id are ordered by leaf (equal rows take neighbouring coordinates, in either order); ids
must be integers (64 bits, negative ones too); an empty table has no tree and no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bases, in_partitions, table, written

# Fixed value: the fields of a document's leaf, in their order.
DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SPAN = 1024
WORD_BITS = 6
FAN_BITS = 10
TIE_DIGITS = 4
COPIES_PER_ROW = 1024

PROOF = "position long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF = pa.schema([
    ("_g", pa.string()), ("position", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
    ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
])


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def _hex(*digests: bytes) -> bytes:
    return b"".join(digests).hex().encode()


def node_digest(children: list[bytes]) -> bytes:
    """A node hashes its children's digests as hex text."""
    return sha256(_hex(*children)).digest()


class Slots:
    """The levels above a block of slots; ``arity`` neighbours make a node."""

    def __init__(self, slots: list[bytes], arity: int):
        self.arity, self.levels = arity, [slots]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([node_digest(low[i : i + arity]) for i in range(0, len(low), arity)])

    @property
    def node(self) -> bytes:
        return self.levels[-1][0]

    def path(self, slot: int) -> list[tuple[int, list[bytes]]]:
        """Of each level: the place in its run, and the run's other nodes."""
        out = []
        for level in self.levels[:-1]:
            start = slot - slot % self.arity
            run = level[start : start + self.arity]
            out.append((slot - start, run[: slot - start] + run[slot - start + 1 :]))
            slot //= self.arity
        return out


def lone(node: bytes, times: int) -> bytes:
    """A last node without neighbours is hashed alone, level by level."""
    for _ in range(times):
        node = node_digest([node])
    return node


def fold(node: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    for at, others in path:
        node = node_digest([*others[:at], node, *others[at:]])
    return node


def pack_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    """Of each level two bytes, place and number of siblings, and the siblings."""
    return b"".join(bytes([at, len(others)]) + b"".join(others) for at, others in path)


def unpack_path(data: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(data):
        at, n = data[i], data[i + 1]
        i += 2
        out.append((at, [data[i + 32 * k : i + 32 * k + 32] for k in range(n)]))
        i += 32 * n
    return out


def _digests(data: bytes) -> list[bytes]:
    return [data[i : i + 32] for i in range(0, len(data), 32)]


class _Shape:
    """Levels in a block, for an arity."""

    def __init__(self, arity: int):
        if not 2 <= arity <= 255:
            raise ValueError("arity must be from 2 to 255")
        self.arity, self.levels = arity, 1
        while arity ** (self.levels + 1) <= SPAN:
            self.levels += 1
        self.span = arity**self.levels


def words(ids: DataFrame) -> DataFrame:
    """The bitmap of (_g, _id): written (_g, word, bits, rows, more); ``more`` lists (bit, further rows) of repeated ids."""
    counted = ids.groupBy("_g", F.shiftright("_id", WORD_BITS).alias("word"), F.col("_id").bitwiseAND((1 << WORD_BITS) - 1).alias("bit")).agg(F.count(F.lit(1)).alias("n"))
    bit = F.coalesce(F.col("bit"), F.lit(0)).cast("int")
    repeated = F.when(F.col("n") > 1, F.struct(bit.alias("bit"), (F.col("n") - 1).alias("n")))
    return written(counted.groupBy("_g", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(coalesce(bit, 0) as int))")).alias("bits"), F.sum("n").alias("rows"), F.collect_list(repeated).alias("more"),
    ), "merkle-words")


def directory(bitmap: DataFrame) -> DataFrame:
    """The words and ``before``, the rows of the group in earlier words. A null word is the first one."""
    ends = bitmap.agg(F.min("word").alias("low"), F.max("word").alias("high")).first()
    levels = [bitmap.groupBy("_g", "word").agg(F.sum("rows").alias("rows"))]
    low, high = ends["low"] or 0, ends["high"] or 0
    while high - low >= 1 << FAN_BITS:
        low, high = low >> FAN_BITS, high >> FAN_BITS
        levels.append(levels[-1].groupBy("_g", F.shiftright("word", FAN_BITS).alias("word")).agg(F.sum("rows").alias("rows")))
    earlier = lambda *by: F.coalesce(F.sum("rows").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first("word")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = levels[-1].select("_g", "word", earlier("_g").alias("before"))
    for level in reversed(levels[:-1]):
        own = level.withColumn("parent", F.shiftright("word", FAN_BITS)).withColumn("own", earlier("_g", "parent"))
        up = above.select(F.col("_g").alias("up_g"), F.col("word").alias("up"), "before")
        above = own.join(up, (F.col("_g") == F.col("up_g")) & F.col("parent").eqNullSafe(F.col("up"))).select("_g", "word", (F.col("own") + F.col("before")).alias("before"))
    found = above.select(F.col("_g").alias("d_g"), F.col("word").alias("d_word"), "before")
    return bitmap.join(found, (F.col("_g") == F.col("d_g")) & F.col("word").eqNullSafe(F.col("d_word"))).drop("d_g", "d_word")


def coordinates(leaves: DataFrame) -> DataFrame:
    """Rows (_g, _id, leaf, shown) with ``pos``, the place of the leaf in its group's ascending order."""
    bitmap = words(leaves.select("_g", "_id"))
    ranks = directory(bitmap).select(F.col("_g").alias("w_g"), "word", "bits", "more", "before")
    keyed = leaves.withColumn("bit", F.coalesce(F.col("_id").bitwiseAND((1 << WORD_BITS) - 1), F.lit(0)).cast("int"))
    here = (F.col("_g") == F.col("w_g")) & F.shiftright("_id", WORD_BITS).eqNullSafe(F.col("word"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))").cast("long")
    further = F.expr("aggregate(filter(more, m -> m.bit < bit), 0L, (s, m) -> s + m.n)")
    placed = keyed.join(ranks, here).select(
        "_g", "_id", "leaf", "shown", (F.col("before") + below + F.when(F.size("more") > 0, further).otherwise(F.lit(0))).alias("pos"),
        F.expr("exists(more, m -> m.bit = bit)").alias("tied"),
    )
    if bitmap.where(F.size("more") > 0).isEmpty():
        return placed.drop("tied")
    placed = written(placed, "merkle-coordinates")
    return placed.where(~F.col("tied")).drop("tied").unionByName(_ordered_ties(placed.where("tied").drop("tied")))


def _ordered_ties(tied: DataFrame) -> DataFrame:
    """Rows of one id, all with the first one's ``pos``, one after another by leaf.

    Equal rows are counted, not ordered: their coordinates are listed from the count. Leaves are digests, so their first
    digits deal the different rows of one id into groups of even size, with prefix sums over the groups.
    """
    own = ["_g", "_id", "pos"]
    counted = tied.groupBy(*own, "leaf", "shown").agg(F.count(F.lit(1)).alias("copies")).withColumn("part", F.substring(F.hex("leaf"), 1, TIE_DIGITS))
    counted = written(counted, "merkle-ties")
    sums = counted.groupBy(*own, "part").agg(F.sum("copies").alias("copies"))
    before = lambda by, order: F.coalesce(F.sum("copies").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = sums.select(F.col("_g").alias("p_g"), F.col("_id").alias("p_id"), F.col("part").alias("p_part"), before(own, ["part"]).alias("earlier"))
    same = (F.col("_g") == F.col("p_g")) & F.col("_id").eqNullSafe(F.col("p_id")) & (F.col("part") == F.col("p_part"))
    ranked = counted.withColumn("inside", before([*own, "part"], ["leaf", F.asc_nulls_first("shown")])).join(groups, same)
    first = ranked.select(
        "_g", "_id", "leaf", "shown", "copies", (F.col("pos") + F.col("earlier") + F.col("inside")).alias("pos"),
        F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_PER_ROW}L)")).alias("from"),
    ).repartition("_g", "pos", "from")
    return first.select(
        "_g", "_id", "leaf", "shown", F.explode(F.expr(f"sequence(pos + from, pos + least(copies, from + {COPIES_PER_ROW}) - 1)")).alias("pos"),
    )


def _leaf_blocks(placed: DataFrame, shape: _Shape) -> DataFrame:
    """Written blocks of leaves: _g, block, ids, has (flags), leaves and shown (packed by slot), node, levels reduced."""

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        leaves, shown = t["leaf"].to_pylist(), t["shown"].to_pylist()
        tree = Slots(leaves, shape.arity)
        return pa.table({
            "_g": [key[0].as_py()], "block": [key[1].as_py()],
            "ids": [t["_id"].fill_null(0).to_numpy().astype("<i8").tobytes()], "has": [bytes(x is not None for x in t["_id"].to_pylist())],
            "leaves": [b"".join(leaves)], "shown": [b"".join(s or x for s, x in zip(shown, leaves))],
            "node": [tree.node], "levels": pa.array([len(tree.levels) - 1], pa.int32()),
        }, schema=pa.schema([("_g", pa.string()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "has", "leaves", "shown", "node")], ("levels", pa.int32())]))

    keyed = placed.withColumn("block", F.expr(f"pos div {shape.span}"))
    return written(keyed.groupBy("_g", "block").applyInArrow(pack, "_g string, block long, ids binary, has binary, leaves binary, shown binary, node binary, levels int"), "merkle-leaves")


def _climb(nodes: DataFrame, shape: _Shape) -> tuple[list[DataFrame], DataFrame]:
    """From nodes (_g, pos, node, levels) to each tree's top (_g, node), and the rounds between: (_g, block, slots, node,
    levels, pos: that of the block). A block that stands alone in its tree is its top."""

    def reduce(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        slots = t["node"].to_pylist()
        alone = key[1].as_py() == 0 and len(slots) == 1
        if not alone:
            slots = [lone(s, shape.levels - n) for s, n in zip(slots, t["levels"].to_pylist())]
        tree = Slots(slots, shape.arity)
        return pa.table({"_g": [key[0].as_py()], "pos": [key[1].as_py()], "slots": pa.array([b"".join(slots)], pa.binary()), "node": pa.array([tree.node], pa.binary()),
                         "levels": pa.array([len(tree.levels) - 1], pa.int32())})

    rounds = []
    while (nodes.agg(F.max("pos")).first()[0] or 0) > 0:
        keyed = nodes.select("_g", F.expr(f"pos div {shape.span}").alias("block"), "pos", "node", "levels")
        nodes = written(keyed.groupBy("_g", "block").applyInArrow(reduce, "_g string, pos long, slots binary, node binary, levels int"), "merkle-round")
        rounds.append(nodes)
    return rounds, nodes.select("_g", "node")


def _block_path(tree: Slots, slot: int, sole: bool, shape: _Shape) -> list[tuple[int, list[bytes]]]:
    """A slot's levels in its block: in a tree of several blocks always ``shape.levels``, the last of them alone if need be."""
    path = tree.path(slot)
    return path if sole else path + [(0, [])] * (shape.levels - len(path))


def _descend(rounds: list[DataFrame], tops: DataFrame, shape: _Shape) -> DataFrame:
    """From tops (_g, path, subroot, root) to (_g, pos, path, sole, subroot, root) of every node that the first round took.

    ``sole``: the node is its tree's only one, so it needs no levels of its own block's height.
    """

    def spread(key: tuple, t: pa.Table) -> pa.Table:
        block = key[1].as_py()
        path, sole, slots, subroot, root = (t[c][0].as_py() for c in ("path", "sole", "slots", "subroot", "root"))
        digests = _digests(slots)
        n = len(digests)
        if block == 0 and n == 1:
            paths, child_sole = [path], True
        else:
            tree = Slots(digests, shape.arity)
            paths, child_sole = [pack_path(_block_path(tree, s, sole, shape)) + path for s in range(n)], False
        return pa.table({
            "_g": [key[0].as_py()] * n, "pos": [block * shape.span + s for s in range(n)], "path": pa.array(paths, pa.binary()), "sole": [child_sole] * n,
            "subroot": pa.array([subroot] * n, pa.binary()), "root": pa.array([root] * n, pa.binary()),
        })

    known = tops.select("_g", F.lit(0).cast("long").alias("pos"), "path", F.lit(True).alias("sole"), "subroot", "root")
    for level in reversed(rounds):
        joined = level.select("_g", "pos", "slots").join(known, ["_g", "pos"])
        known = written(joined.groupBy("_g", "pos").applyInArrow(spread, "_g string, pos long, path binary, sole boolean, subroot binary, root binary"), "merkle-paths")
    return known


def merkle_proofs(
    documents: DataFrame, group: str = "lang", key: str = "doc_id", fields: tuple[str, ...] = DOCUMENT_FIELDS, arity: int = 2, presented: dict[str, Column] | None = None,
) -> DataFrame:
    """Of every row: group, position in the group, key, leaf, subroot, root, proof_sha256 (of the siblings' digests as hex
    text, from the leaf up), folded_root (from the row as it is presented and the original siblings) and verified.

    ``presented`` maps fields to the values that the row is presented with; without it rows are presented as they are.
    """
    if not isinstance(documents.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer")
    shape, presented = _Shape(arity), presented or {}
    leaf = leaf_digest([F.col(c) for c in fields])
    changed = [~F.col(c).eqNullSafe(v) for c, v in presented.items() if c in fields]
    other = F.lit(None).cast("binary")
    if changed:
        any_changed = changed[0]
        for c in changed[1:]:
            any_changed = any_changed | c
        other = F.when(any_changed, leaf_digest([presented.get(c, F.col(c)) for c in fields]))
    # A group's key is text that sorts as the group does, null first, and is never null itself.
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = written(documents.select(name.alias("_g"), F.col(key).cast("long").alias("_id"), leaf.alias("leaf"), other.alias("shown")), "merkle-digests")
    blocks = _leaf_blocks(coordinates(leaves), shape)
    rounds, subroots = _climb(blocks.select("_g", F.col("block").alias("pos"), "node", "levels"), shape)

    # The tree of the groups' roots: their places in the groups' order, then the same way.
    ordered = written(in_partitions(subroots, "_g"), "merkle-groups")
    firsts = bases(ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "part", "n").select("part", "first_n")
    placed = written(ordered.join(firsts, "part").select(F.col("_g").alias("name"), F.col("node").alias("subroot"), (F.col("first_n") + F.col("local")).alias("pos")), "merkle-groups")
    upper, roots = _climb(placed.select(F.lit("").alias("_g"), "pos", F.col("subroot").alias("node"), F.lit(shape.levels).alias("levels")), shape)
    over = _descend(upper, roots.select("_g", F.lit(b"").alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root")), shape)
    tops = placed.join(over.select("pos", "path", "root"), "pos").select(F.col("name").alias("_g"), "path", "subroot", "root")
    paths = _descend(rounds, tops, shape)

    def prove(key: tuple, t: pa.Table) -> pa.Table:
        name, block = (k.as_py() for k in key)
        path, sole, subroot, root = (t[c][0].as_py() for c in ("path", "sole", "subroot", "root"))
        leaves, shown, has = _digests(t["leaves"][0].as_py()), _digests(t["shown"][0].as_py()), t["has"][0].as_py()
        ids = np.frombuffer(t["ids"][0].as_py(), "<i8").tolist()
        tree, above = Slots(leaves, shape.arity), unpack_path(path)
        above_hex = _hex(*(s for _, others in above for s in others))
        rows = []
        for slot, (i, known, leaf, show) in enumerate(zip(ids, has, leaves, shown)):
            own = _block_path(tree, slot, sole, shape)
            proof = sha256(_hex(*(s for _, others in own for s in others)) + above_hex).hexdigest()
            folded = fold(show, own + above)
            rows.append((name, block * shape.span + slot, i if known else None, leaf.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _PROOF)], schema=_PROOF)

    whole = blocks.select("_g", F.col("block").alias("pos"), "ids", "has", "leaves", "shown").join(paths, ["_g", "pos"])
    proved = whole.groupBy("_g", "pos").applyInArrow(prove, f"_g string, {PROOF}")
    back = F.when(F.col("_g") != "", F.expr("substring(_g, 2)")).cast(documents.schema[group].dataType)
    return proved.select(back.alias(group), "position", F.col("doc_id").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1).otherwise(F.col("n_chars").cast("decimal(38,0)"))
    proofs = merkle_proofs(table(spark, sf_dir, "documents"), presented={"n_chars": one_more})
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# The crc32 is worked out byte by byte from its table of 256 entries, which a rule gives.
OP13_SQL = """WITH RECURSIVE
bytewise AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
),
told AS (
  SELECT d.*, doc_id::VARCHAR AS s, t FROM documents d, bytewise
),
hashed AS (
  SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda ch: unicode(ch)::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 7 = 0, false) AS tampered FROM told
),
fields AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS tree,
    coalesce(strlen(s) || ':' || s, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    n_chars, CASE WHEN tampered THEN n_chars + 1 ELSE n_chars END AS shown_chars, coalesce(strlen(text) || ':' || text, '-') AS z FROM hashed
),
digests AS (
  SELECT doc_id, tree, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
    sha256(a || coalesce(strlen(shown_chars::VARCHAR) || ':' || shown_chars, '-') || z) AS shown FROM fields
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total FROM digests
),
nodes AS (
  SELECT 0 AS lvl, tree, pos, leaf AS h, total FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(total) + 1) // 2 FROM nodes WHERE total > 1 GROUP BY lvl, tree, pos // 2
),
subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1
),
tops AS (
  SELECT 0 AS lvl, pos, subroot AS h, total FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(total) + 1) // 2 FROM tops WHERE total > 1 GROUP BY lvl, pos // 2
),
walk AS (
  SELECT doc_id, leaf, tree, 0 AS lvl, pos, total, '' AS proof, shown AS folded FROM leaves
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.lvl + 1, w.pos // 2, (w.total + 1) // 2, w.proof || coalesce(n.h, ''),
    sha256(CASE WHEN w.pos % 2 = 0 THEN w.folded || coalesce(n.h, '') ELSE n.h || w.folded END)
  FROM walk w LEFT JOIN nodes n ON n.lvl = w.lvl AND n.tree = w.tree AND n.pos = xor(w.pos, 1) WHERE w.total > 1
),
above AS (
  SELECT w.doc_id, w.leaf, s.subroot, 0 AS lvl, s.pos, s.total, w.proof, w.folded FROM walk w JOIN subroots s USING (tree) WHERE w.total = 1
  UNION ALL
  SELECT a.doc_id, a.leaf, a.subroot, a.lvl + 1, a.pos // 2, (a.total + 1) // 2, a.proof || coalesce(n.h, ''),
    sha256(CASE WHEN a.pos % 2 = 0 THEN a.folded || coalesce(n.h, '') ELSE n.h || a.folded END)
  FROM above a LEFT JOIN tops n ON n.lvl = a.lvl AND n.pos = xor(a.pos, 1) WHERE a.total > 1
)
SELECT a.doc_id, a.leaf, a.subroot, r.h AS root, sha256(a.proof) AS proof_sha256, a.folded AS folded_root, a.folded = r.h AS verified
FROM above a, (SELECT h FROM tops WHERE total = 1) r WHERE a.total = 1
"""
