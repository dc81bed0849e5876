"""Language ID by word-first backoff.

From training documents each language gets log frequencies of its words and of its words' byte
n-grams (``LONGEST`` bytes down to one, word bounds included). A text's words are scored one after
another: a known word by its log frequency in each language; an unseen word place by place with the
longest n-gram that ends there and is known, backing off to shorter ones where it is not. The
language with the highest sum (and log share of documents) is predicted; the score is its
posterior probability.

Every word and n-gram of the training documents is known, however rare. The ``HOT`` most frequent
words, or fewer, are broadcast as packed arrays, as a shortcut; documents look all others up by a join on the word's 64-bit
hash. Words that no training document has are scored once each by their n-grams: from the ``HOT`` most frequent n-grams, packed
alike, where these tell all places of a word, and by a join of all its n-grams where they don't.

Words are runs between white space, lower-cased, less the ASCII characters around them that are no
letters. Null texts and texts without a letter get ``und`` and score 0, as do all texts if nothing
could be learned. Ties go to the language first in order. A null doc_id counts as the empty text where
folds are drawn. Repeated rows are predicted alike; an empty table gives an empty result. Columns other
than doc_id, text and lang are not looked at, and lang only to learn.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm import grams
from tarnkeep.llm.common import crc_of_id, materialize

LONGEST = 5
#: Words that are broadcast, at most, and n-grams.
HOT = 1 << 19
FOLDS, HELD = 4, 2
UNKNOWN = "und"
_EDGES = bytes(c for c in range(128) if not chr(c).isalpha())
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def words(text: str) -> list[bytes]:
    stripped = (w.strip(_EDGES) for w in text.lower().encode("utf-8", "surrogatepass").split())
    return [w for w in stripped if w]


def _labelled(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    return rows.filter((crc_of_id(FOLDS) != HELD) & F.col("lang").isNotNull())


def _log(count: Column, total: int, kinds: int) -> Column:
    """Log frequency from a count; ``kinds``: how many are known in all."""
    kinds = 0.5 * max(1, kinds)
    return F.log((count + 0.5) / F.lit(max(1.0, float(total)) + kinds))


def recognisable(text: Column) -> Column:
    """Whether a text has a letter; false for null."""
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


class Languages:
    """What training documents say: ``words`` and ``grams`` with log frequencies v0, v1, ... by language."""

    def __init__(self, docs: DataFrame) -> None:
        labelled = _labelled(docs)
        counted = sorted((r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect())
        self.languages = [lang for lang, _ in counted]
        if not counted:
            return
        documents = np.array([n for _, n in counted], dtype=float)
        self.prior = np.log(documents / documents.sum())
        wide = materialize(self._counted(labelled))
        totals = wide.agg(F.count("*").alias("kinds"), *self._sums("c")).first()
        self.words = wide.select("word", F.xxhash64("word").alias("h"), "n", *(
            _log(F.col(f"c{i}"), totals[f"c{i}"] or 0, totals["kinds"]).alias(f"v{i}") for i in self._range()
        ))
        found = materialize(self._gram_counts(wide))
        sums = {r["size"]: r for r in found.groupBy("size").agg(F.count("*").alias("kinds"), *self._sums("c")).collect()}

        def by_size(i: int) -> Column:
            v = F.lit(None).cast("double")
            for size, r in sums.items():
                v = F.when(F.col("size") == size, _log(F.col(f"c{i}"), r[f"c{i}"], r["kinds"])).otherwise(v)
            return v

        n = reduce(Column.__add__, [F.col(f"c{i}") for i in self._range()])
        self.grams = found.select("size", "gram", n.alias("n"), *(by_size(i).alias(f"v{i}") for i in self._range()))

    def _range(self) -> range:
        return range(len(self.languages))

    def _sums(self, name: str) -> list[Column]:
        return [F.sum(f"{name}{i}").alias(f"{name}{i}") for i in self._range()]

    def _counted(self, labelled: DataFrame) -> DataFrame:
        """word, n, c0, c1, ...: each word's counts in all training documents."""

        def count(frames):
            counts: dict[str, Counter] = defaultdict(Counter)

            def made():
                rows = [(k, w, n) for k, c in counts.items() for w, n in c.items()]
                counts.clear()
                return pd.DataFrame(rows, columns=["lang", "word", "n"])

            for frame in frames:
                for lang, text in zip(frame["lang"], frame["text"], strict=True):
                    counts[lang].update(words(text or ""))
                if sum(map(len, counts.values())) > 300_000:
                    yield made()
            yield made()

        rows = labelled.select("lang", "text").mapInPandas(count, "lang string, word binary, n long")
        return rows.groupBy("word").agg(F.sum("n").alias("n"), *(
            F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"c{i}")
            for i, lang in enumerate(self.languages)
        ))

    def _gram_counts(self, wide: DataFrame) -> DataFrame:
        names = [f"c{i}" for i in self._range()]

        def of_words(frames):
            for frame in frames:
                data, begins = grams.lines(list(frame["word"]))
                word = grams.word_of(len(data), begins)
                weights = frame[names].to_numpy(np.int64)
                for size in range(1, LONGEST + 1):
                    keys, ends = grams.grams(data, begins, size)
                    keys, counts = grams.summed(keys, weights[word[ends]])
                    made = pd.DataFrame(counts, columns=names)
                    made.insert(0, "gram", keys.view(np.int64))
                    made.insert(0, "size", size)
                    yield made

        schema = "size int, gram long, " + ", ".join(f"{c} long" for c in names)
        return wide.select("word", *names).mapInPandas(of_words, schema).groupBy("size", "gram").agg(*self._sums("c"))

    def _vectors(self, table: DataFrame, key: list[str], most: int) -> tuple[pa.Table, np.ndarray, bool]:
        """The most frequent rows, ``most`` of them or fewer, their log frequencies, and whether these are all."""
        sizes = table.groupBy("n").agg(F.count("*").alias("c")).collect()  # distinct counts only
        least, room = None, most
        for r in sorted(sizes, reverse=True):
            room -= r["c"]
            if room < 0:
                break
            least = r["n"]
        kept = table.filter(F.lit(False) if least is None else F.col("n") >= least)
        found = kept.select(*key, *(f"v{i}" for i in self._range())).toArrow()
        vectors = np.stack([found.column(f"v{i}").to_numpy() for i in self._range()], axis=1)
        return found, vectors, room >= 0

    def hot(self, most: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The most frequent words: their bytes, ends, and log frequencies."""
        found, vectors, _ = self._vectors(self.words, ["word"], most)
        held = found.column("word").to_pylist()
        return b"".join(held), np.cumsum(np.fromiter(map(len, held), np.int64, len(held))), vectors

    def hot_grams(self, most: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], bool]:
        """By size the most frequent n-grams in order and their log frequencies, and whether these are all."""
        found, vectors, whole = self._vectors(self.grams, ["size", "gram"], most)
        size, gram = found.column("size").to_numpy(), found.column("gram").to_numpy().view(np.uint64)
        out = {}
        for s in range(1, LONGEST + 1):
            here = np.flatnonzero(size == s)
            here = here[np.argsort(gram[here])]
            out[s] = (gram[here], vectors[here])
        return out, whole

    def unseen(self, new: DataFrame, hot: int) -> DataFrame:
        """h, v0, v1, ... of words (h, word): means over a word's bytes of the longest known n-grams' log frequencies.

        An n-gram known nowhere says nothing. So a word counts as much as its rarest-known part, not
        as all of its parts together.
        """
        names = [f"v{i}" for i in self._range()]
        tables, whole = self.hot_grams(hot)
        packed = new.sparkSession.sparkContext.broadcast(tables)

        def told(frames):
            """Words whose places all end with n-grams of the packed ones; others come along as they are."""
            for frame in frames:
                data, begins = grams.lines(list(frame["word"]))
                word, place = grams.word_of(len(data), begins), grams.place_in_word(len(data), begins)
                vectors, is_open = np.zeros((len(data), len(names))), np.zeros(len(data), dtype=bool)
                for size in range(1, LONGEST + 1):
                    keys, ends = grams.grams(data, begins, size)
                    keep = place[ends] > 0  # nothing ends before the first byte
                    keys, ends = keys[keep], ends[keep]
                    known, values = packed.value[size]
                    at = grams.find(known, keys)
                    vectors[ends[at >= 0]] = values[at[at >= 0]]
                    # a longer one may be known, though it is not packed
                    is_open[ends] = (at < 0) & (not whole)
                starts = begins[:-1]
                sums = np.add.reduceat(vectors, starts) / np.diff(begins)[:, None]
                left = np.logical_or.reduceat(is_open, starts)
                made = pd.DataFrame(sums, columns=names)
                made.insert(0, "word", frame["word"].where(pd.Series(left), None))
                made.insert(0, "h", frame["h"])
                yield made

        scored = materialize(new.mapInPandas(told, "h long, word binary, " + ", ".join(f"{v} double" for v in names)))
        done = scored.filter("word IS NULL").select("h", *names)
        return done if whole else done.unionByName(self._joined(scored.filter("word IS NOT NULL").select("h", "word")))

    def _joined(self, new: DataFrame) -> DataFrame:
        """As :meth:`unseen`, by a join with all n-grams."""

        def split(frames):
            for frame in frames:
                data, begins = grams.lines(list(frame["word"]))
                word, place = grams.word_of(len(data), begins), grams.place_in_word(len(data), begins)
                lengths, h = np.diff(begins), frame["h"].to_numpy()
                for size in range(1, LONGEST + 1):
                    keys, ends = grams.grams(data, begins, size)
                    keep = place[ends] > 0
                    keys, ends = keys[keep].view(np.int64), ends[keep]
                    yield pd.DataFrame({
                        "h": h[word[ends]], "bytes": lengths[word[ends]], "place": place[ends],
                        "size": size, "gram": keys,
                    })

        places = new.mapInPandas(split, "h long, bytes long, place long, size int, gram long")
        short = F.col("size") <= 2  # at most 2**16 + 2**8 n-grams, each in many words
        found = places.filter(~short).join(self.grams.filter(~short).drop("n"), ["size", "gram"]).unionByName(
            places.filter(short).join(F.broadcast(self.grams.filter(short).drop("n")), ["size", "gram"])
        )
        vector = F.struct(*(f"v{i}" for i in self._range()))
        longest = found.groupBy("h", "bytes", "place").agg(F.max_by(vector, "size").alias("v"))
        return longest.groupBy("h", "bytes").agg(
            *(F.sum(F.col("v")[f"v{i}"]).alias(f"s{i}") for i in self._range())
        ).select("h", *((F.col(f"s{i}") / F.col("bytes")).alias(f"v{i}") for i in self._range()))


_ROWS = (
    "doc_id long, key long, held_out boolean, learned boolean, row long, total array<double>,"
    " h array<long>, times array<int>, new array<binary>"
)


def _partly(batches, packed, prior: np.ndarray):
    """Documents with the sums of their frequent words; the other words' hashes and counts.

    Words that may be new, those of documents not learned from, come along themselves.
    """
    data, ends, vectors = packed
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    known = {data[a:b]: i for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True))}
    get, digest = known.get, xxhash.xxh64_intdigest
    base = TaskContext.get().partitionId() << 36
    for batch in batches:
        texts = batch.column("text").to_pylist()
        learned = batch.column("learned").to_pylist()
        judged = [t is not None and has_letter(t) for t in texts]
        counts = [Counter(words(t)) if j else {} for t, j in zip(texts, judged, strict=True)]
        sizes = np.fromiter(map(len, counts), np.int64, len(counts))
        at = np.fromiter((get(w, -1) for c in counts for w in c), np.int64, sizes.sum())
        times = np.fromiter(chain.from_iterable(c.values() for c in counts), np.int64, sizes.sum())
        doc = np.repeat(np.arange(len(counts)), sizes)
        total = np.tile(prior, (len(counts), 1))
        here = at >= 0
        for i in range(len(prior)):
            total[:, i] += np.bincount(doc[here], vectors[at[here], i] * times[here], len(counts))
        rare = [[w for w in c if w not in known] for c in counts]
        offsets = pa.array(np.append(0, np.cumsum(np.fromiter(map(len, rare), np.int64, len(rare)))), pa.int32())
        hashes = np.fromiter((digest(w, 42) for r in rare for w in r), np.uint64, int((~here).sum())).view(np.int64)
        sums = np.append(0, np.cumsum(np.where(judged, len(prior), 0)))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("key"), batch.column("held_out"), batch.column("learned"),
            pa.array(base + np.arange(len(texts))),
            pa.ListArray.from_arrays(pa.array(sums, pa.int32()), pa.array(total[np.array(judged, bool)].ravel())),
            pa.ListArray.from_arrays(offsets, pa.array(hashes)),
            pa.ListArray.from_arrays(offsets, pa.array(times[~here], pa.int32())),
            pa.array([[] if k else r for k, r in zip(learned, rare, strict=True)], pa.list_(pa.binary())),
        ], names=["doc_id", "key", "held_out", "learned", "row", "total", "h", "times", "new"])
        base += len(texts)


def report(docs: DataFrame, hot: int = HOT, key: str | None = None) -> DataFrame:
    """Contract columns of every document.

    ``key``: a long column of ``docs`` that comes along as ``key``, with ``learned_any``, whether
    any language was learned.
    """
    spark = docs.sparkSession
    model = Languages(docs)
    n = len(model.languages)
    carried = F.col(key).cast("long") if key else F.lit(None).cast("long")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), carried.alias("key"),
    ).withColumn("held_out", crc_of_id(FOLDS) == HELD)
    extra = ["key", F.lit(bool(n)).alias("learned_any")] if key else []
    if not n:
        return texts.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), *extra
        )
    frequent = spark.sparkContext.broadcast(model.hot(hot))
    prior = model.prior
    learned = (~F.col("held_out") & F.col("lang").isNotNull()).alias("learned")
    rows = materialize(
        texts.select("doc_id", "key", "text", "held_out", learned)
        .mapInArrow(lambda batches: _partly(batches, frequent.value, prior), _ROWS)
    )
    vector = [f"v{i}" for i in range(n)]
    asked = rows.select("row", F.inline(F.arrays_zip("h", "times")))
    new = rows.select(F.explode("new").alias("word")).distinct().select(F.xxhash64("word").alias("h"), "word")
    unseen = model.unseen(new.join(model.words.select("h"), "h", "left_anti"), hot)
    vectors = model.words.select("h", *vector).unionByName(unseen)
    more = asked.join(vectors, "h").groupBy(F.col("row").alias("r")).agg(
        *(F.sum(F.col(v) * F.col("times")).alias(v) for v in vector)
    )
    total = F.transform(
        "total", lambda x, i: x + F.coalesce(F.get(F.array(*vector), i), F.lit(0.0))
    )
    judged = rows.join(more, rows["row"] == more["r"], "left").withColumn("total", total)
    best = F.array_max("total")
    names = F.array(*[F.lit(x) for x in model.languages])
    odds = F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - best))
    some = F.size("total") > 0  # texts without a letter have no sums
    # ties go to the language first in order
    first = F.get(names, F.array_position("total", best).cast("int") - 1)
    return judged.select(
        "doc_id", "held_out", F.when(some, first).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(some, 1 / odds).otherwise(0.0).alias("score"), *extra,
    )
