"""Near-duplicate documents: an exact Jaccard join (0.75) of five-word shingle sets, by prefix tries.

1. Every text becomes its set of 64-bit shingle hashes. Sets are dealt out by hash range, packed, and each range counts
   in how many different sets a shingle is. Only shingles of two or more sets can be part of an overlap, so from here
   on a set is its repeated shingles and its whole size; a set with less than 3/4 of its shingles repeated is similar
   to no other and leaves. Equal sets are one from the start (96-bit digest of the set).
2. The global order of shingles is by falling rarity: number of sets, then hash.
3. Sets that share a minimum hash are compared with one of them, the one whose shingles are most common; linear in the
   number of sets, this joins large families of copies into few components.
4. What is left is completed exactly: two similar sets share a shingle among the first ``size - 3/4 size + 1`` of their
   order, so sets in different components that do, and whose remaining lengths from there can still suffice, are
   compared too. This makes the components exact, without most pairs inside a component.
5. A comparison puts the sets to be compared with one set, block by block, into a trie (see ``prefix_trie``).
6. Components of the links, and of equal sets, give ``component_id``.
7. Similar sets are in one component, so the whole join compares all sets of a component whose sizes allow it, block by
   block, each block a trie that is probed with every set of the other: ``similar_sets`` lists the links, ``n_links``
   counts them (a family of n edited copies has up to n * (n - 1) / 2) without listing.

What tells two shingles apart is their range's number and 48 more bits of their hash: some shingle of one document
agrees by chance with another one of a compared document with a probability of about 10**-9 for documents of a thousand
words and 10**-7 for ten thousand, before the number of ranges lowers it further.

Defined cases: a null, empty or word-less text has an empty set, is linked with nothing and is its own component; fewer
than five words are one shingle; rows with the same id are rows of their own, linked by their texts; a null id takes
part and is the component's id only if all ids in it are null; an empty table gives an empty result; other columns are
neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table
from .components import components
from .prefix_trie import PrefixTrie, enough, local_ranks
from .word_hash import mix, word_hashes

WORDS = 5
BUCKET_TEXT_BYTES = 16 << 20
FLUSH_SHINGLES = 1 << 20
MOST_SHINGLES = 1 << 22
BLOCK_SETS = 128
MINIMA = 4
# Sizes of similar sets are at most one band apart: the ratio of two bands' starts is above 4/3.
BAND = 1.34
DIGEST_BYTES = 12
DIGEST = f"V{DIGEST_BYTES}"
_FACTORS = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The set of a text: ascending hashes of its different five-word runs."""
    words, _ = word_hashes(text)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    runs = len(words) - size + 1
    total = np.full(runs, size, np.uint64)
    for k in range(size):
        total += words[k : k + runs] * _FACTORS[k]
    return np.unique(mix(total))


def _packed(held: list[tuple[bytes, np.ndarray]], buckets: int) -> list[tuple[int, bytes, bytes, bytes, bytes]]:
    """For each hash range that has shingles of the sets: its number, and of those sets digests, sizes, numbers of
    shingles there, and the shingles, six bytes each.

    The range is taken from a hash's lowest bits, the six bytes are the others, so both together tell shingles apart.
    """
    values = np.concatenate([s for _, s in held])
    sizes = np.array([len(s) for _, s in held], np.uint32)
    owner = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
    low = (values & np.uint64(0xFFFF)) << np.uint64(16) | values >> np.uint64(16) & np.uint64(0xFFFF)
    bucket = (low * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    owner = owner[order]
    six = (values[order] >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    digests = np.frombuffer(b"".join(d for d, _ in held), DIGEST)
    out = []
    for b in np.flatnonzero(np.diff(ends, prepend=0)):
        part = slice(ends[b - 1] if b else 0, ends[b])
        first = np.flatnonzero(np.diff(owner[part], prepend=-1))
        who, count = owner[part][first], np.diff(np.append(first, part.stop - part.start))
        out.append((int(b), digests[who].tobytes(), sizes[who].astype("<u4").tobytes(), count.astype("<u4").tobytes(), six[part].tobytes()))
    return out


def _repeated(bucket: int, blobs: list[tuple[bytes, bytes, bytes, bytes]], groups: int) -> Iterator[tuple]:
    """Of one hash range, the shingles of two or more sets: for each group of sets its number, and of its sets digests,
    sizes, numbers of such shingles, those shingles, and in how many sets each is."""
    digests = np.frombuffer(b"".join(b[0] for b in blobs), DIGEST)
    sizes, counts = (np.frombuffer(b"".join(b[k] for b in blobs), "<u4") for k in (1, 2))
    six = np.frombuffer(b"".join(b[3] for b in blobs), np.uint8).reshape(-1, 6)
    eight = np.empty((len(six), 8), np.uint8)
    eight[:, 2:] = six
    eight[:, :2] = np.array([bucket & 0xFFFF], "<u2").view(np.uint8)
    values = eight.view("<u8").ravel()
    ordered = np.sort(values)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return
    again = again[np.concatenate([[True], again[1:] != again[:-1]])]
    at = np.minimum(np.searchsorted(again, values), len(again) - 1)
    hit = again[at] == values
    # Equal sets count once.
    parts = digests.view("<u4").reshape(-1, 3)
    order = np.lexsort((parts[:, 2], parts[:, 1], parts[:, 0]))
    new = np.concatenate([[True], (parts[order][1:] != parts[order][:-1]).any(axis=1)])
    number = np.empty(len(digests), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    owner, value = np.repeat(number, counts)[hit], at[hit]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
    owner, value = owner[keep], value[keep]
    of = np.bincount(value, minlength=len(again))
    keep = of[value] > 1
    owner, value = owner[keep], value[keep]
    if not len(owner):
        return
    # Rows for the next exchange: the sets of a group, packed like the input.
    group = parts[first][:, 0].astype(np.uint64) * np.uint64(groups) >> np.uint64(32)
    order = np.lexsort((value, owner, group[owner]))
    owner, value = owner[order], value[order]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    count, who = np.diff(np.append(starts, len(owner))), owner[starts]
    new = np.flatnonzero(np.diff(group[who].astype(np.int64), prepend=-1))
    ends = np.append(starts, len(owner))
    for lo, hi in zip(new, np.append(new[1:], len(who))):
        d, v = first[who[lo:hi]], value[ends[lo] : ends[hi]]
        yield (int(group[who[lo]]), digests[d].tobytes(), sizes[d].astype("<u4").tobytes(), count[lo:hi].astype("<u4").tobytes(),
               again[v].tobytes(), of[v].astype("<u4").tobytes())


def _digest(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.astype("<u8").tobytes())[:DIGEST_BYTES] if len(found) else None


def _documents(d: DataFrame) -> DataFrame:
    """key, set size and digest (null for an empty set) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, digests = [], []
            for x in b.column(1):  # one text and one set at a time, however many a batch holds
                found = shingles(x.as_py())
                sizes.append(len(found))
                digests.append(_digest(found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())], names=["key", "size", "digest"])

    out = T.StructType([d.schema["key"], T.StructField("size", T.IntegerType()), T.StructField("digest", T.BinaryType())])
    return d.mapInArrow(run, out)


PACKED = ("bucket", "digests", "sizes", "counts", "shingles")
GROUPED = ("part", "digests", "sizes", "counts", "shingles", "in_sets")
SET = "digest binary, size int, shingles binary, in_sets binary"


def _repeated_parts(d: DataFrame) -> DataFrame:
    """Packed repeated shingles, a row for each hash range and group of sets (``part``)."""
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_TEXT_BYTES))
    # A packet for each range that a task has seen: few shingles make poor packets, but what a task holds is bounded.
    flush = min(max(FLUSH_SHINGLES, 32 * buckets), MOST_SHINGLES)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        waiting = 0

        def packed() -> pa.RecordBatch:
            columns = zip(*_packed(list(held.items()), buckets))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(columns)], names=PACKED)

        for b in batches:
            for x in b.column(0):
                found = shingles(x.as_py())
                digest = _digest(found)
                if digest is not None and digest not in held:
                    held[digest] = found
                    waiting += len(found)
                    if waiting >= flush:
                        yield packed()
                        held, waiting = {}, 0
        if held:
            yield packed()

    def count(key: tuple, t: pa.Table) -> pa.Table:
        blobs = list(zip(*(t[c].to_pylist() for c in PACKED[1:])))
        found = list(zip(*_repeated(key[0].as_py(), blobs, buckets))) or [()] * len(GROUPED)
        return pa.table({c: pa.array(x, pa.binary() if c != "part" else pa.int32()) for c, x in zip(GROUPED, found)})

    dealt = d.select("text").mapInArrow(deal, "bucket int, digests binary, sizes binary, counts binary, shingles binary")
    return dealt.groupBy("bucket").applyInArrow(count, "part int, digests binary, sizes binary, counts binary, shingles binary, in_sets binary")


def _ordered_sets(parts: DataFrame) -> DataFrame:
    """Checkpointed (digest, size, shingles, in_sets) in global order, of sets with 3/4 of their shingles repeated."""

    def order(t: pa.Table) -> pa.Table:
        digests = np.frombuffer(b"".join(t["digests"].to_pylist()), DIGEST)
        sizes, counts, in_sets = (np.frombuffer(b"".join(t[c].to_pylist()), "<u4") for c in ("sizes", "counts", "in_sets"))
        values = np.frombuffer(b"".join(t["shingles"].to_pylist()), "<u8")
        known, number = np.unique(digests.view("<u4").reshape(-1, 3), axis=0, return_inverse=True)
        number = number.ravel()
        size = np.zeros(len(known), np.int64)
        size[number] = sizes
        owner = np.repeat(number, counts)
        repeated = np.bincount(owner, minlength=len(known))
        kept = (4 * repeated >= 3 * size)[owner]
        owner, values, in_sets = owner[kept], values[kept], in_sets[kept]
        at = np.lexsort((values, in_sets, owner))
        owner, values, in_sets = owner[at], values[at], in_sets[at]
        ends = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        who = owner[ends[:-1]]
        cuts = list(zip(ends[:-1], ends[1:]))
        return pa.table({
            "digest": pa.array([known[w].tobytes() for w in who], pa.binary()), "size": pa.array(size[who], pa.int32()),
            "shingles": pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary()), "in_sets": pa.array([in_sets[a:b].tobytes() for a, b in cuts], pa.binary()),
        })

    return cut(parts.groupBy("part").applyInArrow(order, SET))


def _star_pairs(sets: DataFrame) -> DataFrame:
    """(probe, stored): of the sets with an equal minimum hash, the one of most common shingles with each other one.

    Common is a set by the mean logarithm of its shingles' numbers of sets. Those of an original are in all its copies,
    a copy's own ones in none, so the original of a family of copies comes first.
    """

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest, place, least, common = [], [], [], []
            for d, n, s, c in zip(*(x.to_pylist() for x in b.columns)):
                v = np.frombuffer(s, "<u8")
                for k in range(MINIMA):
                    digest.append(d)
                    place.append(k)
                    least.append(int(mix(v ^ _FACTORS[k]).min() >> np.uint64(1)))
                    common.append(float(np.log2(np.frombuffer(c, "<u4")).sum()) / n)
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(place, pa.int32()), pa.array(least, pa.int64()), pa.array(common, pa.float64())],
                                             names=["digest", "place", "least", "common"])

    keyed = cut(sets.mapInArrow(minima, "digest binary, place int, least long, common double"))
    hubs = cut(
        keyed.groupBy("place", "least")
        .agg(F.max(F.struct("common", "digest")).alias("best"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("place", "least", F.col("best.digest").alias("probe"))
    )
    return keyed.join(hubs, ["place", "least"]).where("probe <> digest").select("probe", F.col("digest").alias("stored")).distinct()


def _candidate_pairs(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(probe, stored): sets of different components that share a shingle early enough to be similar."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, n, s, label in zip(*(b.column(k).to_pylist() for k in range(4))):
                v = np.frombuffer(s, "<u8")
                length = len(v) - -(-3 * n // 4) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(v[:length].view("<i8"), pa.int64()), pa.array([d] * length, pa.binary()), pa.array([label] * length, pa.binary()),
                    pa.array([n] * length, pa.int32()), pa.array(np.arange(len(v) - 1, len(v) - 1 - length, -1, dtype=np.int32)),
                ], names=["shingle", "digest", "label", "size", "left"])

    own = sets.select("digest", "size", "shingles").join(labels.select(F.col("node").alias("digest"), "label"), "digest", "left")
    own = own.select("digest", "size", "shingles", F.coalesce("label", "digest").alias("label"))
    postings = cut(own.mapInArrow(prefixes, "shingle long, digest binary, label binary, size int, left int"))
    several = cut(postings.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("shingle"))
    across = cut(postings.join(several, "shingle"))
    # The longest rest and the smallest set of a component bound what any pair of two components can reach.
    lists = cut(across.groupBy("shingle", "label").agg(F.min("size").alias("least"), F.max("left").alias("most")))
    x, y = (lists.select("shingle", *[F.col(c).alias(f"{c}_{n}") for c in ("label", "least", "most")]) for n in "xy")
    reach = F.expr("7 * (1 + least(most_x, most_y)) >= 3 * (least_x + least_y)")
    meet = cut(x.join(y, "shingle").where(F.expr("label_x < label_y") & reach).select("shingle", "label_x", "label_y", "least_y", "most_y"))
    side = lambda n: across.select("shingle", *[F.col(c).alias(f"{c}_{n}") for c in ("digest", "label", "size", "left")])
    # The same bound again with each set of the first component, before it meets those of the second.
    reach = F.expr("7 * (1 + least(left_x, most_y)) >= 3 * (size_x + least_y)")
    near = [F.col(f"m.{c}") == F.col(f"x.{c}") for c in ("shingle", "label_x")]
    first = meet.alias("m").join(side("x").alias("x"), [*near, reach]).select("m.*", "digest_x", "size_x", "left_x")
    pairs = first.join(side("y"), ["shingle", "label_y"])
    fits = pairs.where("7 * (1 + least(left_x, left_y)) >= 3 * (size_x + size_y)")
    return fits.select(F.col("digest_x").alias("probe"), F.col("digest_y").alias("stored")).distinct()


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Checkpointed (a, b): the pairs (probe, stored) that are similar; each probe meets a trie of its stored sets."""
    pairs = cut(pairs)
    blocks = cut(pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks")))
    dealt = cut(pairs.join(blocks, "probe").withColumn("block", F.pmod(F.xxhash64("stored"), "blocks")).drop("blocks"))
    stored = dealt.withColumnRenamed("stored", "digest").join(sets, "digest").withColumn("is_probe", F.lit(False))
    probes = dealt.select("probe", "block", F.col("probe").alias("digest")).distinct().join(sets, "digest").withColumn("is_probe", F.lit(True))
    columns = ["probe", "block", "is_probe", "digest", "size", "shingles", "in_sets"]

    def compare(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t[c].to_pylist() for c in columns[2:])), key=lambda r: not r[0])  # the probe first
        ranks = local_ranks([(np.frombuffer(r[3], "<u8"), np.frombuffer(r[4], "<u4")) for r in rows])
        found = PrefixTrie(ranks[1:], [r[2] for r in rows[1:]]).similar(ranks[0], rows[0][2])
        return pa.table({"a": pa.array([rows[0][1]] * len(found), pa.binary()), "b": pa.array([rows[1 + i][1] for i in found], pa.binary())})

    return cut(stored.select(columns).unionByName(probes.select(columns)).groupBy("probe", "block").applyInArrow(compare, "a binary, b binary"))


def _inside(sets: DataFrame, labels: DataFrame, classes: DataFrame, listed: bool) -> DataFrame:
    """All links: (a, b) if listed, else (digest, n), partial sums of the rows (``copies``) of the sets similar to one.

    labels: digest, label of the linked sets; classes: digest, copies.
    """
    band = F.floor(F.log("size") / math.log(BAND)).cast("long")
    sized = cut(labels.join(sets.select("digest", "size"), "digest").join(classes.select("digest", "copies"), "digest").withColumn("band", band))
    cells = sized.groupBy("label", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    members = cut(sized.join(cells, ["label", "band"]).withColumn("block", F.pmod(F.xxhash64("digest"), "blocks")).drop("blocks"))
    blocks = cut(members.groupBy("label", "band", "block").agg(F.count(F.lit(1)).alias("n")))
    x, y = (blocks.select("label", *[F.col(c).alias(f"{c}_{side}") for c in ("band", "block", "n")]) for side in "xy")
    same = F.expr("band_x = band_y and block_x = block_y")
    meet = x.join(y, "label").where("band_y = band_x + 1 or band_y = band_x and block_x <= block_y").where(~same | (F.col("n_x") > 1))
    meeting = ["label", "band_x", "block_x", "band_y", "block_y"]
    meet = cut(meet.select(*meeting))
    columns = ["is_probe", "digest", "size", "copies", "shingles", "in_sets"]
    whole = members.join(sets.select("digest", "shingles", "in_sets"), "digest")

    def side(pairs: DataFrame, name: str) -> DataFrame:
        own = whole.withColumnsRenamed({"band": f"band_{name}", "block": f"block_{name}"}).withColumn("is_probe", F.lit(name == "x"))
        return pairs.join(own, ["label", f"band_{name}", f"block_{name}"]).select(*meeting, *columns)

    def compare(t: pa.Table) -> pa.Table:
        probe, digest, size, copies, shingle, in_sets = (t[c].to_pylist() for c in columns)
        ranks = local_ranks([(np.frombuffer(v, "<u8"), np.frombuffer(n, "<u4")) for v, n in zip(shingle, in_sets)])
        probes, stored = ([i for i, p in enumerate(probe) if p == side] for side in (True, False))
        alone = not stored
        stored = stored or probes
        trie = PrefixTrie([ranks[i] for i in stored], [size[i] for i in stored])
        links = [(i, stored[k]) for i in probes for k in trie.similar(ranks[i], size[i]) if not alone or i < stored[k]]
        if listed:
            return pa.table({"a": pa.array([digest[i] for i, _ in links], pa.binary()), "b": pa.array([digest[j] for _, j in links], pa.binary())})
        n = [0] * len(digest)
        for i, j in links:
            n[i] += copies[j]
            n[j] += copies[i]
        return pa.table({"digest": pa.array([d for d, k in zip(digest, n) if k], pa.binary()), "n": pa.array([k for k in n if k], pa.int64())})

    both = side(meet, "x").unionByName(side(meet.where(~same), "y"))
    return both.groupBy(*meeting).applyInArrow(compare, "a binary, b binary" if listed else "digest binary, n long")


def _joined(d: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sets, labels (digest, label) of the linked ones, documents, and classes of equal sets (digest, least key, copies)."""
    sets = _ordered_sets(_repeated_parts(d))
    links = _links(_star_pairs(sets), sets)
    labels = components(links)
    links = links.unionByName(_links(_candidate_pairs(sets, labels), sets))
    labels = components(links).select(F.col("node").alias("digest"), "label")
    docs = cut(_documents(d))
    classes = docs.where("digest is not null").groupBy("digest").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    return sets, labels, docs, cut(classes)


def similar_sets(documents: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The whole join: every link (a, b) between different sets, once, and the members (key, digest) of the sets.

    Rows of one set (equal digests) are similar too; rows without a word have no set and aren't listed.
    """
    sets, labels, docs, classes = _joined(documents.select(F.col(key).alias("key"), F.col(text).alias("text")))
    return _inside(sets, labels, classes, listed=True), docs.where("digest is not null").select(F.col("key").alias(key), "digest")


def near_duplicates(documents: DataFrame, text: str = "text", key: str = "doc_id", with_links: bool = False) -> DataFrame:
    """key, n_shingles (set size) and component_id (least key reachable by links) of each row; with_links: also n_links,
    the number of other rows that it is similar to, those of an equal set among them."""
    sets, labels, docs, classes = _joined(documents.select(F.col(key).alias("key"), F.col(text).alias("text")))
    named = cut(classes.join(labels, "digest", "left").select("digest", "least", "copies", F.coalesce("label", "digest").alias("label")))
    of_label = cut(named.groupBy("label").agg(F.min("least").alias("component")))
    of_class = named.join(of_label, "label").select("digest", "component", "copies")
    if with_links:
        found = cut(_inside(sets, labels, classes, listed=False).groupBy("digest").agg(F.sum("n").alias("n")))
        of_class = of_class.join(found, "digest", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("n", F.lit(0)))
    columns = ["key", "size", "component"] + ["n_links"] * with_links
    linked = docs.where("digest is not null").join(cut(of_class), "digest").select(columns)
    alone = docs.where("digest is null").withColumn("component", F.col("key")).withColumn("n_links", F.lit(0).cast("long")).select(columns)
    return linked.unionByName(alone).select(F.col("key").alias(key), F.col("size").cast("long").alias("n_shingles"), F.col("component").alias("component_id"), *columns[3:])


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), with_links=True)
