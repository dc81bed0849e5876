"""URL filters: rules by host and path, and a character language-model ratio for the rest.

URLs that a rule allows or blocks teach two variable-order Markov models of characters. A model's
probability of a byte is that of the longest context (``ORDER`` bytes at most) it has seen, smoothed
by the shorter ones (Witten-Bell) down to the uniform distribution. A url's score is the difference
of its two log likelihoods divided by its length. The threshold between the verdicts is calibrated
on the labelled urls: the cut of a fixed scale of ``STEPS`` scores with the fewest errors, both
labels weighing alike.

A context's counts are kept if the context makes up at least ``LEAST`` of its label's bytes, so what
is broadcast is bounded at any number of urls.

Models look at host and path of a url without the labels of the host that rules name. A null url or
one without ``://`` has an empty host and path, fits no rule, and is judged by the method as an empty
text; ties and an uncalibrated method (no labelled url of either kind) allow. Repeated rows are judged
alike; an empty table gives an empty result. Columns other than page_id and url are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import materialize, per_text

#: Verdict, host, path.
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ORDER = 4
LEAST = 1e-5
STEPS = 400
WIDEST = 4.0  # scores beyond it count as it


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    has = F.locate("://", url) > 0
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    empty = F.lit("")
    return (
        F.when(has, F.translate(host, upper, lower)).otherwise(empty),
        F.when(has, path).otherwise(empty),
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class Markov:
    """log2 probabilities of bytes by their longest seen context."""

    def __init__(self, after: dict[bytes, dict[int, int]]) -> None:
        self.after = {
            c: ({s: math.log2(p) for s, p in ps.items()}, math.log2(rest))
            for c, (ps, rest) in self._smoothed(after).items()
        }

    @staticmethod
    def _smoothed(after) -> dict:
        done: dict[bytes, tuple[dict[int, float], float]] = {b"": ({}, 1 / 256)}

        def of(context: bytes, symbol: int) -> float:
            weight = 1.0
            while True:
                if context in done:
                    ps, rest = done[context]
                    if symbol in ps:
                        return weight * ps[symbol]
                    weight *= rest
                    if not context:
                        return weight
                context = context[1:]

        for c in sorted(after, key=len):
            total, kinds = sum(after[c].values()), len(after[c])
            rest = kinds / (total + kinds)
            short = {s: of(c[1:], s) if c else 1 / 256 for s in after[c]}
            ps = {s: n / (total + kinds) + rest * short[s] for s, n in after[c].items()}
            done[c] = ps, rest if c else rest / 256
        return done

    def mean(self, text: bytes) -> float:
        line, total = b"\xfe" + text + b"\xff", 0.0
        for i in range(1, len(line)):
            context, symbol = line[max(0, i - ORDER) : i], line[i]
            while True:
                state = self.after.get(context)
                if state is not None:
                    p = state[0].get(symbol)
                    if p is not None:
                        total += p
                        break
                    total += state[1]
                    if not context:
                        break
                context = context[1:]
        return total / (len(line) - 1)


def _seen(host: Column, path: Column, rules=RULES) -> Column:
    """What the models look at: rules' own words would only repeat the rules."""
    named = "|".join(
        sorted({h.replace(".", r"\.") for _, h, _ in rules}, key=len, reverse=True)
    )
    return F.concat(F.regexp_replace(host, rf"(^|\.)({named})$", ""), path)


def _counts(labelled: DataFrame) -> dict[str, dict[bytes, dict[int, int]]]:
    def count(frames):
        counts: Counter = Counter()

        def made():
            frame = pd.DataFrame(
                [(v, c, s, n) for (v, c, s), n in counts.items()],
                columns=["verdict", "context", "symbol", "n"],
            )
            counts.clear()
            return frame

        for frame in frames:
            for verdict, text in zip(frame["verdict"], frame["seen"], strict=True):
                line = b"\xfe" + text.encode("utf-8", "surrogatepass") + b"\xff"
                for i in range(1, len(line)):
                    for size in range(min(i, ORDER) + 1):
                        counts[verdict, line[i - size : i], line[i]] += 1
            if len(counts) > 500_000:
                yield made()
        yield made()

    rows = labelled.select("verdict", "seen").mapInPandas(
        count, "verdict string, context binary, symbol int, n long"
    ).groupBy("verdict", "context", "symbol").agg(F.sum("n").alias("n"))
    grouped = materialize(
        rows.groupBy("verdict", "context").agg(
            F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("after")
        )
    )
    totals = {
        r["verdict"]: r["total"]
        for r in grouped.filter(F.length("context") == 0).select("verdict", "total").collect()
    }
    out: dict[str, dict] = {"allow": {}, "block": {}}
    enough = F.lit(False)
    for verdict, total in totals.items():
        enough |= (F.col("verdict") == verdict) & (F.col("total") >= max(2, math.ceil(LEAST * total)))
    # contexts of one size: at most 1/LEAST
    for r in grouped.filter(enough).toLocalIterator():
        out[r["verdict"]][bytes(r["context"])] = {x["symbol"]: x["n"] for x in r["after"]}
    return out


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    host, path = parts(F.coalesce(F.col("url").cast("string"), F.lit("")))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select(
        "*", rule.alias("rule"), verdict.alias("verdict"),
        _seen(F.col("host"), F.col("path"), rules).alias("seen"),
    )
    labelled = rows.filter(F.col("verdict").isNotNull())
    counts = _counts(labelled)
    usable = all(counts.values())
    models = pages.sparkSession.sparkContext.broadcast(
        (Markov(counts["allow"]), Markov(counts["block"])) if usable else None
    )

    def make():
        pair = models.value

        def of(texts):
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            return pd.DataFrame({"score": np.array([
                pair[0].mean(t) - pair[1].mean(t) if pair else 0.0 for t in raw
            ], dtype=float)})

        return of

    scored = rows.withColumn("score", per_text(make, "score double", "seen")["score"])
    cut = calibrate(scored.filter(F.col("verdict").isNotNull())) if usable else 0.0
    by_method = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "score"
    )


def calibrate(scored: DataFrame) -> float:
    """The score at or above which urls are allowed."""
    bucket = F.floor(
        (F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), "score")) + WIDEST) * (STEPS / 2 / WIDEST)
    ).cast("int")
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(STEPS + 1))
    for r in scored.groupBy("verdict", bucket.alias("b")).count().collect():
        counts[r["verdict"]][r["b"]] += r["count"]
    allow, block = (counts[v] / max(1, counts[v].sum()) for v in ("allow", "block"))
    # errors if the buckets below a cut are blocked; of equal cuts the middle one
    errors = np.append(0, np.cumsum(allow)) + block.sum() - np.append(0, np.cumsum(block))
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(best[len(best) // 2]) * (2 * WIDEST / STEPS) - WIDEST
