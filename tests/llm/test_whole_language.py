"""Every trained word and n-gram is known, whatever its share."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tarnkeep.llm import common, language


def brute_force(rows):
    counts, grams, documents = defaultdict(Counter), defaultdict(Counter), Counter()

    def of(word):
        bounded = b"\xfe" + word + b"\xff"
        for end in range(1, len(bounded) + 1):
            for size in range(1, min(5, end) + 1):
                yield end - 1, size, bounded[end - size : end]

    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            documents[lang] += 1
            for w in language.words(text or ""):
                counts[lang][w] += 1
                for _, size, g in of(w):
                    grams[lang, size][g] += 1
    langs = sorted(documents)

    def log(table, x):
        kinds = len(set().union(*(t for t in table)))
        return [math.log((t[x] + 0.5) / (max(1, t.total()) + 0.5 * kinds)) for t in table]

    by_word = [counts[k] for k in langs]
    by_gram = {s: [grams[k, s] for k in langs] for s in range(1, 6)}
    out = {}
    for i, text, _ in rows:
        if not text or not language.has_letter(text):
            out[i] = ("und", 0.0)
            continue
        total = [math.log(documents[k] / documents.total()) for k in langs]
        for w in language.words(text):
            if any(t[w] for t in by_word):
                v = log(by_word, w)
            else:
                longest = {}
                for place, size, g in of(w):
                    if place and any(t[g] for t in by_gram[size]):
                        longest[place] = log(by_gram[size], g)
                v = [sum(x) / (len(w) + 2) for x in zip(*longest.values(), strict=True)] or [0.0] * len(langs)
            total = [x + y for x, y in zip(total, v, strict=True)]
        best = max(total)
        out[i] = (langs[total.index(best)], 1 / sum(math.exp(x - best) for x in total))
    return out


@pytest.mark.parametrize("hot", [100_000, 8, 0])
def test_scores_equal_brute_force(spark, hot):
    rng = random.Random(2)
    parts = {"xx": ["lor", "em", "ip", "a"], "yy": ["züg", "em", "ßo", "a"], "zz": ["qu", "ip", "ßo", "e"]}
    rows = []
    for i in range(80):
        lang = rng.choice(sorted(parts))
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(8))
        rows.append((i, text, lang if i % 9 else None))
    rows += [(200, None, "xx"), (201, "12 !", "xx"), (202, "Ж", None), (203, "lor lor new", None)]
    docs = common.prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in language.report(docs, hot=hot).collect()}
    assert len(got) == len(rows)
    for i, (lang, score) in brute_force(rows).items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-6, i


def test_rare_words_stay_known_in_a_large_corpus(spark):
    """150,000 other words: a word seen once is below a share of 1e-5, yet known."""
    rows = [(i, "common " * 15_000, k) for i, k in enumerate(["xx", "yy"] * 10)]
    rows += [(1000 + i, "zebra", "yy") for i in range(2)] + [(2000, "zebra", None)]
    docs = common.prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    words = {bytes(r.word) for r in language.Languages(docs).words.collect()}
    assert {b"common", b"zebra"} == words
