"""Spelling variants: all pairs of words one edit apart, by composing acceptors with a one-edit transducer.

1. Words and their numbers of occurrences, by expressions and one aggregation.
2. The composition A o E o A of the vocabulary's acceptor with the transducer that copies, makes one edit and copies on is
   deterministic if the edit is made where the two words first differ: each pair is accepted along one path, with one
   position of the edit. So the pairs can be dealt out by that position without doubles. Words of the shorter length m
   (and those of m + 1 for insertions) whose edit lies in [lo, hi) agree in the first ``lo`` and the last ``m - hi`` code
   points, which lead from the acceptor's initial state to one state and on to the end: this pair of strings is the
   partition. At first a word is in the partition of its first half's edits and in that of its second half's. A partition
   that is too large, or whose middle is too long, is halved again, down to one position, where no more words can be than
   letters allow: so a task's size is bounded whatever the vocabulary.
3. In a partition the middles of the words become a minimised acceptor (equal right languages are one state) for each of
   the two lengths; the composition walks from the initial states, makes the edit at each pair of different arcs, and
   intersects the right languages of the two states behind it, which are remembered by pair of states.
4. Each word's near words are counted, the most frequent one is its form if frequent enough, and forms are followed to
   their roots by doubling, a join for each doubling. A form occurs several times as often as its word, so chains end.

Defined cases: a null text has no runs; a null doc_id counts as an empty one in the hash of a run; repeated rows count
each; runs and words may be of any length; without words the result is empty; ties between forms go to the smallest word
in code-point order; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

# The letters of a run, and what is lower-cased.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
DAMAGE_MOD = 199
PARTITION_BYTES = 1 << 20
LONGEST_MIDDLE = 64

NEAR = "word string, n_near long, best_n long, best string"


class Acceptor:
    """The minimal acyclic acceptor of a sorted list of different words; states are numbers, equal ones are one."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        open_: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            self._close(open_, last, shared)
            open_ += [(False, {}) for _ in word[shared:]]
            open_[-1] = (True, open_[-1][1])
            last = word
        self._close(open_, last, 0)
        self.start = self._state(*open_[0])

    def _close(self, open_: list, last: str, depth: int) -> None:
        """The states of the last word below ``depth`` get no more arcs."""
        while len(open_) - 1 > depth:
            done = self._state(*open_.pop())
            open_[-1][1][last[len(open_) - 1]] = done

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]


class Both:
    """Right languages that a state of one acceptor and a state of another one share."""

    def __init__(self, a: Acceptor, b: Acceptor):
        self.a, self.b = a, b
        self.known: dict[tuple[int, int], list[str]] = {}

    def __call__(self, p: int, q: int) -> list[str]:
        found = self.known.get((p, q))
        if found is None:
            found = [""] if self.a.final[p] and self.b.final[q] else []
            after = self.b.arcs[q]
            for c, r in self.a.arcs[p].items():
                if (s := after.get(c)) is not None:
                    found += [c + x for x in self(r, s)]
            self.known[p, q] = found
        return found


def replaced(a: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs of accepted words that differ in one code point: a o (copy, replace, copy) o a."""
    both = Both(a, a)
    walk = [(a.start, "")]
    while walk:
        state, read = walk.pop()
        arcs = list(a.arcs[state].items())
        for i, (c, r) in enumerate(arcs):
            walk.append((r, read + c))
            for d, s in arcs[:i]:
                for rest in both(r, s):
                    yield read + d + rest, read + c + rest


def inserted(a: Acceptor, b: Acceptor, at_end: bool) -> Iterator[tuple[str, str]]:
    """Pairs (word of a, word of b) of which the second has one code point more, where they first differ:
    a o (copy, insert, copy) o b. ``at_end``: it may also follow the whole first word."""
    both = Both(a, b)
    walk = [(a.start, b.start, "")]
    while walk:
        p, q, read = walk.pop()
        for c, r in b.arcs[q].items():
            for rest in both(p, r):
                if rest[0] != c if rest else at_end:
                    yield read + rest, read + c + rest
            if (s := a.arcs[p].get(c)) is not None:
                walk.append((s, r, read + c))


def partition_pairs(short: list[str], long: list[str], at_end: bool) -> Iterator[tuple[str, str]]:
    """All pairs of middles one edit apart: two of the short ones, or a short and a long one."""
    a = Acceptor(sorted(short))
    if len(short) > 1:
        yield from replaced(a)
    if long:
        yield from inserted(a, Acceptor(sorted(long)), at_end)


def word_counts(documents: DataFrame, text: str = "text", key: str = "doc_id", damage: bool = True) -> DataFrame:
    """(word, n): lower-cased runs of letters, each possibly with a code point deleted as its hash says (``damage``)."""
    runs = documents.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    word: Column = F.col("run")
    if damage:
        h = F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("run")).cast("binary"))
        runs = runs.where(F.length("run") >= MIN_LENGTH).withColumn("h", h)
        word = F.when(F.col("h") % DAMAGE_MOD == 0, F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _keyed(parts: DataFrame) -> DataFrame:
    """Parts (word, n, m, short, lo, hi) with the hash of their partition; what it merges by chance is told apart later."""
    ends = F.expr("struct(m, lo, hi, substring(word, 1, lo), right(word, greatest(0, m - hi)))")
    return parts.withColumn("key", F.xxhash64(ends))


def _partitions(words: DataFrame) -> DataFrame:
    """Written parts of partitions that hold a pair at least by size, none larger than one task should take."""
    length = F.length("word")
    roles = F.array(F.struct(length.alias("m"), F.lit(True).alias("short")), F.struct((length - 1).alias("m"), F.lit(False).alias("short")))
    as_roles = words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.m", "r.short").where(F.col("m") >= MIN_LENGTH)
    halves = lambda lo, hi: f"array(struct({lo} as lo, ({lo} + {hi}) div 2 as hi), struct(({lo} + {hi}) div 2 as lo, {hi} as hi))"
    parts = as_roles.select("*", F.explode(F.expr(halves("0L", "cast(m + 1 as long)"))).alias("e")).select("word", "n", "m", "short", F.expr("int(e.lo)").alias("lo"), F.expr("int(e.hi)").alias("hi"))
    ready = None
    while True:
        keyed = _keyed(parts)
        sizes = keyed.groupBy("key").agg(F.sum(F.octet_length("word") + F.lit(8)).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("short").alias("any_short"))
        large = (F.col("bytes") > PARTITION_BYTES) | (F.col("hi") - F.col("lo") > LONGEST_MIDDLE)
        sized = written(
            keyed.join(sizes.where("rows > 1 and any_short").select("key", "bytes"), "key").withColumn("large", large & (F.col("hi") - F.col("lo") > 1)).drop("bytes"),
            "variant-parts",
        )
        here = sized.where("not large").drop("large")
        ready = here if ready is None else ready.unionByName(here)
        rest = sized.where("large")
        if rest.isEmpty():
            return ready
        parts = rest.select("word", "n", "m", "short", F.explode(F.expr(halves("cast(lo as long)", "hi"))).alias("e")).select("word", "n", "m", "short", F.expr("int(e.lo)").alias("lo"), F.expr("int(e.hi)").alias("hi"))


def near_words(words: DataFrame) -> DataFrame:
    """Of words (word, n) that have near words: n_near, and the most frequent one (best, best_n)."""

    def of_partition(rows: list[tuple], found: dict[str, list]) -> None:
        # rows: (m, lo, hi, first code points, last ones), word, n, short; one hash may hold several partitions.
        for (m, lo, hi, first, last), own in groupby(sorted(rows), key=lambda r: r[0]):
            counts: tuple[dict, dict] = ({}, {})
            for _, word, n, short in own:
                counts[not short][word[lo : len(word) - len(last)]] = n
            short, long = counts
            if not short or len(short) + len(long) < 2:
                continue
            for x, y in partition_pairs(list(short), list(long), hi > m):
                second = short if len(x) == len(y) else long
                for a, b, n in ((x, y, second[y]), (y, x, short[x])):
                    best = found.setdefault(first + a + last, [0, 0, ""])
                    best[0] += 1
                    if (-n, first + b + last) < (-best[1], best[2]) or not best[1]:
                        best[1], best[2] = n, first + b + last

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        rows: list[tuple] = []
        at = None

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *[pa.array([v[k] for v in found.values()], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]],
                                           names=["word", "n_near", "best_n", "best"])
            found.clear()
            return b

        for b in batches:
            for key, word, n, m, short, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
                if key != at:
                    of_partition(rows, found)
                    rows, at = [], key
                    if len(found) >= 20_000:
                        yield out()
                rows.append(((m, lo, hi, word[:lo], word[len(word) - max(0, m - hi) :]), word, n, short))
        of_partition(rows, found)
        if found:
            yield out()

    parts = _partitions(words).repartition("key").sortWithinPartitions("key").select("key", "word", "n", "m", "short", "lo", "hi")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    near = parts.mapInArrow(compose, NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return near.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): forms followed to the last one, twice as far in each round."""
    links = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(ahead, "root", "left_semi").isEmpty():
            return links
        links = written(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variant-roots")


def spelling_variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """Words (word, n) with form, root, n_near and form_n."""
    words = written(words, "variant-words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    formed = written(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ), "variant-forms")
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")))


# The crc32 is worked out byte by byte from its table of 256 entries, which a rule gives.
OP11_SQL = """WITH RECURSIVE
bytewise AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
counted AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS s, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(s, ''), lambda ch:
      CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [(192 + unicode(ch) // 64)::BIGINT, (128 + unicode(ch) % 64)::BIGINT] END))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM counted, bytewise
),
told AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM told WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
gaps AS (
  SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
longer AS (
  SELECT DISTINCT g.word AS a, w.word AS b FROM gaps g JOIN words w ON g.rest = w.word
),
pairs AS (
  SELECT x.word AS a, y.word AS b FROM gaps x JOIN gaps y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT a, b FROM longer UNION SELECT b, a FROM longer
),
near AS (
  SELECT a AS word, count(*) AS n_near, min({'n': -w.n, 'b': b}) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a
),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 5 * n THEN best.b END AS form, CASE WHEN -best.n >= 5 * n THEN -best.n END AS form_n
  FROM words LEFT JOIN near USING (word)
),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain c USING (word) JOIN formed l ON l.word = c.at WHERE l.form IS NULL
"""
