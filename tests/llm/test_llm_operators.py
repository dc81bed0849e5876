"""The ten operators against brute force, with nulls, ties, repeats, empty and long texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tarnkeep.llm import (
    common, decontaminate, language, merkle, packing, rans, repeats, secrets, simhash,
    suffix_tree, tokens, urls,
)

SCHEMA = "doc_id long, text string, lang string, source string, score string, fp string, row string"


def make(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(*r, *([None] * (7 - len(r)))) for r in rows]
    return common.prepare(spark).createDataFrame(rows, SCHEMA)


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


VOCABULARY = [f"{a}{b}" for a in ("ba", "ko", "té", "ri", "zu") for b in ("la", "mi", "no", "ß", "x")]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    passage = prose(80)
    out = [prose(rng.randint(1, 120)) for _ in range(40)]
    out += [f"{prose(30)} {passage} {prose(30)}" for _ in range(5)]
    out += [out[3], out[3], out[4] + " one", None, "", "   ", "A", passage, prose(6000)]
    out += [passage[:210], "x" * 450, "no\nnl.\n\nB c. d", "1234 !!"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    ids = [*range(len(texts) - 2), 7, None]  # a tie and a null
    return make(spark, [(i, t, "aa", "s") for i, t in zip(ids, texts, strict=True)]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


def keyed(frame):
    rows = [r.asDict() for r in frame.collect()]
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"], str(r)))


def test_every_operator_takes_an_empty_table(spark, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    for frame in (
        secrets.report(empty), suffix_tree.score(empty), language.report(empty), urls.judge(pages),
        packing.pack(empty), simhash.report(empty), decontaminate.report(empty, items),
        rans.round_trip(empty), repeats.report(empty), merkle.report(empty),
    ):
        assert frame.collect() == []


def test_secret_spans(spark):
    key = "AKIA" + "Q7" * 9
    cases = [
        None, "", "Password : 'abc123' tail", "api_key=short token=abcdefg", f"é {key} x",
        "f" * 24 + "g" + "0" * 23, 'secret"  = "abcdefpassword=zzzzzz', "TOKEN=a1b2c3.d", "ſecret=abcdefg",
        "deadbeef" * 5000,
    ]
    rows = keyed(secrets.report(make(spark, list(enumerate(cases)))))
    assign = re.compile(
        r"""(?a)(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for text, row in zip(cases, rows, strict=True):
        want = [
            (m.start(), 0, "assign", m.end())
            for m in assign.finditer(text or "") if len(m.group(1)) >= 6
        ] + [
            (m.start(), 1, "access", m.end())
            for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m.group()) >= 20
        ] + [
            (m.start(), 2, "hex", m.end())
            for m in re.finditer("[0-9a-f]+", text or "") if len(m.group()) >= 24
        ]
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(want))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert row["n_assign"] + row["n_access"] + row["n_hex"] == len(want)


def likelihood(automaton, value):
    """By the definition: transition by transition, characters of a class alike."""
    classes = {"0": "0123456789", "a": "abcdef", "g": "ghijklmnopqrstuvwxyz", "A": "ABCDEF",
               "G": "GHIJKLMNOPQRSTUVWXYZ"}
    at, p = 0, 1.0
    for c in value:
        s = next((k for k, v in classes.items() if c in v), c)
        p *= math.exp(automaton.log[at][s]) / len(classes.get(s, "c"))
        at = automaton.next[at].get(s, automaton.sink)
    return math.log(p * math.exp(automaton.log[at]["$"]))


def test_fixed_lengths_are_learned():
    rng = random.Random(2)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    word = lambda: "".join(rng.choice(VOCABULARY[:3]) for _ in range(rng.randint(3, 12)))
    formats = secrets.Formats({
        "assign": [hexa(rng.choice((18, 40))).encode() for _ in range(400)],
        "ordinary": [word().encode() for _ in range(400)],
    })
    automaton, _ = formats.automata["assign"]
    assert len(automaton.log) > 40
    assert all(abs(sum(math.exp(p) for p in state.values()) - 1) < 1e-9 for state in automaton.log)
    for n in (18, 40):
        new = [hexa(n).encode() for _ in range(300)]
        assert sum(map(formats.accepts, new)) > 280
        for v in new[:20]:
            sequence, chars = secrets.symbols(v)
            assert abs(automaton.score(sequence) + chars - likelihood(automaton, v.decode())) < 1e-6
    for n in (6, 12, 17, 19, 20, 30, 39, 41, 60, 5000):
        assert not any(formats.accepts(hexa(n).encode()) for _ in range(50))
    assert not any(formats.accepts(word().encode()) for _ in range(200))


def test_any_length_is_one_loop_and_cut_values_teach_no_end():
    rng = random.Random(4)
    lines = [["0"] * (1 + int(rng.expovariate(0.1))) + ["$"] for _ in range(400)]
    assert len({tuple(n.items()) for n in secrets.Automaton.infer(lines).next}) < 40
    long = secrets.taught(b"7" * (secrets.LEARNED + 1))
    assert long == ["0"] * secrets.LEARNED
    automaton = secrets.Automaton.infer([long] * 30)
    assert automaton.score(["0"] * 9000) > automaton.score(["0"] * 20 + ["$"] + ["0"] * 5)
    assert secrets.taught(b"7" * secrets.LEARNED)[-1] == "$"


def test_secret_formats_are_found(spark):
    rng = random.Random(2)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'token = "{hexa(18)}" and otherwordsthatarejustlongones') for i in range(200)]
    bare, wrong = hexa(18), hexa(22)
    rows.append((200, f"sée {bare}. here, {wrong} there and thesewordsarelongbutarenosecret"))
    rows += [(201, None), (202, ""), (203, bare), (203, bare), (204, "x " * 50_000 + bare)]
    got = secrets.find_secrets(make(spark, rows)).collect()
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in got}
    assert all(kind == "assign" for i in range(200) for kind, *_ in found[i])
    assert found[200] == [("format", 4, 22)] and found[201] == found[202] == []
    assert found[203] == [("format", 0, 18)] and len(got) == 206
    assert found[204] == [("format", 100_000, 100_018)]


def test_redaction(spark):
    formats = secrets.Formats({})
    df = make(spark, [(1, "é token=abcdefgh end"), (2, None), (3, "clean"), (4, "f" * 30)])
    got = df.select("doc_id", secrets.redacted(formats).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {1: "é [SECRET] end", 2: None, 3: "clean", 4: "[SECRET]"}


def test_suffix_tree_scores(docs):
    rows = docs.select("doc_id", "text").collect()
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2 for r in rows]
    lines = [[*words_of(r.text), None] for r in rows]
    counts = Counter(w for h, line in zip(held, lines, strict=True) if not h for w in line)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(r.doc_id), h, len(line), sum(counts[w] > 0 for w in line), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in line), 6))
        for r, h, line in zip(rows, held, lines, strict=True)
    )
    got = suffix_tree.score(docs).collect()
    assert sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in got
    ) == want
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_suffix_tree_is_a_distribution():
    rng = random.Random(1)
    vocabulary = suffix_tree.Vocabulary([b"", b"a", b"b", b"c"])
    lines = [b" ".join(rng.choice([[b"a", b"b"], [b"c"], [b"a", b"b", b"c"]])) for _ in range(500)]
    _, numbers, begins = vocabulary.numbers(lines)
    counts = np.bincount(numbers, minlength=4)
    pairs = {}
    for level, keys in zip((1, 2), vocabulary.successions(numbers, begins), strict=True):
        pairs[level] = np.unique(keys, return_counts=True)
    tree = suffix_tree.SuffixTree(vocabulary, counts, len(lines), int(counts.sum()), 4, pairs)
    assert len(tree.states[1][0])
    roots = tree.root[[0, 1, 2, 3]]
    for context in range(5):
        known = np.arange(4)
        p = tree._probability(1, np.full(4, context), known)
        assert abs(p.sum() - roots.sum()) < 0.01  # the rest is for words never seen


def test_rare_words_are_contexts_like_frequent_ones(spark):
    """States of rare words, by joins, are those that the tree in memory has for the same counts."""
    rng = random.Random(4)
    common_words = [b"", b"a", b"b", b"c"]
    whole = suffix_tree.Vocabulary([*common_words, b"r", b"s", b"t"])
    lines = []
    for _ in range(300):
        line = [rng.choice([b"a", b"b", b"c"]) for _ in range(4)]
        line += {0: [b"r", b"a"], 1: [b"s", rng.choice([b"a", b"b", b"c"])], 2: [b"t"]}[rng.randrange(3)]
        lines.append(b" ".join(line))
    _, numbers, begins = whole.numbers(lines)
    counts = np.bincount(numbers, minlength=7)
    keys, n = np.unique(whole.successions(numbers, begins)[0], return_counts=True)
    listed = (n >= 2) & (keys % whole.size < 4)
    none = np.zeros(0, dtype=np.int64)
    tree = suffix_tree.SuffixTree(
        whole, counts, len(lines), int(counts.sum()), 7,
        {1: (keys[listed], n[listed]), 2: (none, none)},
    )
    context, weight, pairs, values = tree.states[1]
    want = {
        whole_word: (round(float(w), 9), {
            int(k % whole.size): round(float(v), 9)
            for k, v in zip(pairs, values, strict=True) if k // whole.size == c
        })
        for c, w in zip(context, weight, strict=True)
        if (whole_word := [*common_words, b"r", b"s", b"t", b"", b""][c]) in (b"r", b"s", b"t")
    }
    assert want and b"r" in want
    follows = np.append(numbers, 0)[1:]
    places = spark.createDataFrame(
        [(bytearray(b"rst"[i - 4 : i - 3]), int(f), False)
         for i, f in zip(numbers.tolist(), follows.tolist(), strict=True) if i >= 4]
        + [(bytearray(b"r"), 1, True)] * 5,  # held out: not learned from
        "word binary, next int, held_out boolean",
    )
    words = spark.createDataFrame(
        [(bytearray(w), int(counts[whole.number[w]])) for w in (b"r", b"s", b"t")],
        "word binary, c long",
    )
    roots = np.append(tree.root[:4], [0.0, 0.0])
    got = {
        bytes(r.word): (round(r.weight, 9), {k: round(v, 9) for k, v in r.after.items()})
        for r in suffix_tree.rare_states(places, words, roots).collect()
    }
    assert got == want


def test_rare_words_contribute_to_scores(spark):
    """What always follows a rare word is likely after it, whatever the share of frequent words."""
    rng = random.Random(6)
    plain = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(i, f"{plain(30)} q{i % 5} h {plain(30)}") for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate([None, "", "q1", "q1 h", "q1 a", "zz h", "q1 q2"])]
    docs = make(spark, rows)
    got = {r.doc_id: r for r in suffix_tree.score(docs, frequent=0.02).collect()}
    hot = {r.doc_id: r for r in suffix_tree.score(docs, frequent=1e-9).collect()}
    for i, r in got.items():
        assert r.score <= 1e-9 and (r.n_known, r.n_tokens) == (hot[i].n_known, hot[i].n_tokens)
        assert abs(r.base_score - hot[i].base_score) < 1e-6
    gain = lambda i: got[i].score - got[i].base_score
    assert gain(203) > 0.5 > gain(204)
    assert gain(3) > 0.3


def test_languages(spark):
    rng = random.Random(3)
    alphabets = {"xx": ["lor", "em", "ip"], "yy": ["züg", "ähn", "ßo"]}
    rows = []
    for i in range(120):
        lang = rng.choice(sorted(alphabets))
        parts = alphabets[lang]
        text = " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(20))
        rows.append((i, text, lang, "s"))
    odd = [(200, None), (201, ""), (202, "12 !?"), (203, "züg"), (203, "züg"), (None, "lorem"), (204, "züg " * 20000)]
    got = keyed(language.report(make(spark, rows + odd)))
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 127
    assert all(by[i]["lang_pred"] == lang for i, _, lang, _ in rows)
    assert [by[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3
    assert by[204]["lang_pred"] == "yy" and by[None]["lang_pred"] == "xx"
    assert all(0 <= r["score"] <= 1 for r in got)
    # without labels nothing is learned
    assert {r["lang_pred"] for r in keyed(language.report(make(spark, odd)))} == {"und"}


def test_url_rules(spark):
    cases = {
        "http://a.EXAMPLE.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://x.org/fr/?q=/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://notexample.com/de/x": ("notexample.com", "/de/x", None, None),
        "http://w.example.com/de/x#/y": ("w.example.com", "/de/x", "example.com/de/", "block"),
        "http://x.net": ("x.net", "", None, None), "no scheme.net/": ("", "", None, None),
        None: ("", "", None, None), "": ("", "", None, None), "a://b?c/d": ("b", "", None, None),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    rows = {r["page_id"]: r for r in urls.judge(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] in ("allow", "block") if verdict is None else rows[i]["verdict"] == verdict


def test_tokens_and_packing(docs, texts):
    encoder = tokens.Encoder()
    plain = encoder._tokenizer
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = [*plain.encode(row.text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            want.append((str(row.doc_id), k, at, len(part) // 4, zlib.crc32(part)))
    got = packing.pack(docs).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1


def test_pieces_are_encoded_as_in_whole_texts():
    rng = random.Random(4)
    odd = ["it's", "THE,", "...", "é", "H̱", "İx", "naïve,", "日本。", "<|endoftext|>", "a\x1cb", "1a,", "ß?"]
    lines = [" ".join(rng.choice(odd) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    encoder = tokens.Encoder()
    want = encoder._tokenizer.encode_batch(lines, add_special_tokens=False)
    got = encoder.encode([t.encode() for t in lines])
    assert got == [np.array(e.ids, "<u4").tobytes() for e in want]


def test_simhash(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = []
    for r in rows:
        w = words_of(r.text)
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = parent[i], parent[j]
                parent = [b if p == a else p for p in parent]
    ids = [
        min((r.doc_id for r, q in zip(rows, parent, strict=True) if q == p and r.doc_id is not None), default=None)
        for p in parent
    ]
    want = sorted((str(r.doc_id), f"{f:016x}", str(c)) for r, f, c in zip(rows, prints, ids, strict=True))
    got = simhash.report(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(parent))


@pytest.mark.parametrize("seed", range(4))
def test_trie_links_equal_all_pairs(seed):
    rng = np.random.default_rng(seed)
    keys = set()
    for center in rng.integers(0, 2**63, 6, dtype=np.uint64).tolist():
        for _ in range(40):
            flips = rng.integers(0, 64, rng.integers(0, 5))
            keys.add(int(np.bitwise_xor.reduce([np.uint64(center), *[np.uint64(1) << np.uint64(f) for f in flips]])))
    keys = np.array(sorted(keys), dtype=np.uint64)
    got = simhash.linked(keys, 0)
    label = np.arange(len(keys))
    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(keys ^ keys[i]) <= 2):
            label[label == max(label[i], label[j])] = min(label[i], label[j])
    assert (got == label).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


@pytest.mark.parametrize("block_words", [200_000, 90])
def test_decontamination(spark, docs, texts, block_words):
    passage = texts[46 + 1 + 4]
    item_rows = [
        (1, texts[0]), (2, " ".join(texts[44].split()[35:75])), (3, "kola rimi"), (4, None), (5, "!?"),
        (None, texts[10]), (10, " ".join((texts[44] or "").upper().split()[35:60])), (10, passage),
    ]
    items = spark.createDataFrame(item_rows, "item_id long, text string")
    split = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    )
    windows = {}
    for i, t in item_rows:
        w = split(t)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[s : s + 13]), set()).add("" if i is None else str(i))
    want = []
    for r in docs.select("doc_id", "text").collect():
        w, hit, found = split(r.text), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if (k := tuple(w[s : s + size])) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[k]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((str(r.doc_id), len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    got = decontaminate.report(docs, items, block_words).collect()
    assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    assert any(x[2] for x in want)


def test_spans_are_cut_out():
    cut = decontaminate.removed_spans("One, two; thrée four!", [{"start": 1, "end": 3}])
    assert cut == "One,  four!"


def test_token_files(docs):
    plain = tokens.Encoder()._tokenizer
    rows = docs.select("doc_id", "text").collect()
    want, starts = [], 0
    got = rans.round_trip(docs).collect()
    for r in rows:
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((str(r.doc_id), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == starts
        starts += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 70_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 49_000).astype(np.uint32)
    table, blocks = rans.encode_segment(ids)
    assert (rans.decode_segment(table, blocks) == ids).all()
    if n > 1000:
        counts = np.bincount(ids)
        p = counts[counts > 0] / n
        size = sum(len(b["payload"]) for b in blocks)
        assert size * 8 / n < -(p * np.log2(p)).sum() + 0.4
        broken = [blocks[0] | {"payload": b"\x01" + blocks[0]["payload"][1:]}]
        with pytest.raises(ValueError, match="checksum"):
            rans.decode_segment(table, broken)


@pytest.mark.parametrize("crowd", [4096, 2])
def test_repeated_strings(docs, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = docs.select("doc_id", "text").collect()
    raw = [(r.text or "").encode() for r in rows]
    counts = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    want = []
    for r, b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((str(r.doc_id), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    got = repeats.report(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert any(0 < x[2] < x[1] for x in want)


def test_run_length_index():
    rng = random.Random(6)
    lines = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).encode() for _ in range(30)]
    lines += [lines[0], lines[1] + lines[0]]
    index = repeats.RunLengthIndex(lines)
    suffixes = sorted(
        (t[i:] + b"\xff" + n.to_bytes(2, "big"), index.begins[n] + i)
        for n, t in enumerate(lines) for i in range(len(t) + 1)
    )
    assert index.order.tolist() == [p for _, p in suffixes]
    assert len(index.run_heads) < len(index.text)
    got = index.matching_statistics().tolist()
    clean = [s.split(b"\xff")[0] for s, _ in suffixes]
    for i in range(1, len(clean)):
        common = 0
        while common < min(len(clean[i]), len(clean[i - 1])) and clean[i][common] == clean[i - 1][common]:
            common += 1
        assert got[i] == common


def test_merkle_fingerprints(docs):
    rows = docs.select("doc_id", "text").collect()
    got = merkle.report(docs).collect()
    assert len(got) == len(rows)
    prints = {}
    for r in rows:
        prints.setdefault(r.text or "", merkle.fingerprint(r.text))
    assert len(set(prints.values())) == len(prints)
    assert sorted(r.fingerprint for r in got) == sorted(prints[r.text or ""] for r in rows)
    # neighbours by doc_id, where it is told apart
    line = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    by_id = {r.doc_id: r for r in got}
    for i, r in enumerate(line):
        nxt = line[(i + 1) % len(line)]
        if 7 in (r.doc_id, nxt.doc_id):
            continue
        text = merkle.edited(r.text or "", nxt.text or "")
        out = by_id[r.doc_id]
        assert out.n_chars == len(r.text or "")
        assert out.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert out.edited_fingerprint == merkle.fingerprint(text)
        assert 0 <= out.near_edited <= 1 and 0 <= out.near_next <= 1


def test_merkle_branches_locate_edits():
    a = "One is. Two is. Three is.\nNext line. End.\n"
    b = a.replace("Two", "Too")
    assert merkle.differing(merkle.fingerprint(a), merkle.fingerprint(b)) == [1]
    assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(a)) == 1
    assert 0.5 < merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) < 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("x")) == 0


def test_edits_are_located():
    """Replacing the leaves that edits name turns one text's leaves into the other's."""
    rng = random.Random(17)

    def leaves(text):
        return [x for section in merkle.tree(text) for paragraph in section for x in paragraph]

    def check(a, b):
        x, y = merkle.fingerprint(a), merkle.fingerprint(b)
        old, new, made, at = leaves(a), leaves(b), [], 0
        found = merkle.edits(x, y)
        for start, end, low, high in found:
            made += [*old[at:start], *new[low:high]]
            at = end
        assert [*made, *old[at:]] == new
        assert (x == y) == (not found) == (merkle.likeness(x, y) == 1)
        assert merkle.likeness(x, y) == pytest.approx(merkle.likeness(y, x), abs=0.3)
        return found

    lines = [f"Line {i} says one. And two of {i}!\n" if i % 7 else f"# Head {i}\n" for i in range(60)]
    text = "".join(lines)
    assert check(text, text) == []
    # a deletion, an insertion, a swap of two sentences, a moved paragraph
    without, more = "".join(lines[:20] + lines[21:]), "".join(lines[:20] + ["New here.\n"] + lines[20:])
    (deleted,), (inserted,) = check(text, without), check(text, more)
    assert deleted[1] > deleted[0] and deleted[2] == deleted[3]
    assert inserted[0] == inserted[1] and inserted[3] > inserted[2]
    assert len(check("One. Two. Three.", "Two. One. Three.")) == 2
    assert len(check(text, "".join([*lines[1:30], lines[0], *lines[30:]]))) == 2
    for _ in range(150):
        a = [rng.choice(["x.", "y! ", "z\n", "\n", "# h\n", "w w? "]) for _ in range(rng.randint(0, 30))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 3)] = [rng.choice(["x.", "new. ", "\n"])] * rng.randint(0, 2)
        check("".join(a), "".join(b))


def test_span_places_in_code_points_and_untouched_runs():
    rng = random.Random(3)
    for _ in range(200):
        parts = ["é ", "ab" * 12, " token=Zz9+/zz9 ", "AKIA" + "Q7" * 9, "=", "ß", "z" * 25, "\n", "0f" * 15]
        text = "".join(rng.choice(parts) for _ in range(30)).encode()
        spans = secrets.base_spans(text)
        got = secrets._points(text, spans)
        assert got == [(k, len(text[:s].decode()), len(text[:e].decode())) for s, e, k, _ in spans]
        runs = [m.span() for m in re.finditer(rb"[\w+/=-]+(?:\.[\w+/=-]+)*", text)]
        runs = [(s, e) for s, e in runs if e - s >= 6]
        assert secrets.credential_runs(text, 6) == runs
        free = [r for r in runs if not any(s < r[1] and r[0] < e for s, e, *_ in spans)]
        assert secrets.other_runs(text, spans, 6) == free
        inside = {i for s, e, *_ in spans for i in range(s, e)}
        left = [(s, e) for s, e in runs if not inside.issuperset(range(s, e))]
        assert secrets.candidates(text, spans, 6) == left


@pytest.mark.parametrize("text, letter", [("², ½", False), ("12 é", True), ("_", False), ("日本", True)])
def test_what_a_letter_is(text, letter):
    assert language.has_letter(text) == letter


def test_secret_limits_come_from_all_values_whole(spark):
    rng = random.Random(5)
    keys = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(300)]
    odd = "z" * 5000 + "-"  # longer than what is learned of a value
    rows = [(i, f"token={k}") for i, k in enumerate(keys)] + [(900 + i, f"token={odd}{i}") for i in range(6)]
    docs = make(spark, [*rows, *rows])
    for sample in (40, 400):
        values, asked = {}, secrets.Formats.calibrate

        def spy(self, labelled, taught, values=values, asked=asked):
            values.update(taught)
            asked(self, labelled, taught)

        secrets.Formats.calibrate = spy
        try:
            formats = secrets.learn(docs, sample)
        finally:
            secrets.Formats.calibrate = asked
        taught, automata = values["assign"], formats.without(values["assign"])
        at = {v: i % secrets.PARTS for i, v in enumerate(taught)}
        means = sorted(
            formats._mean(automata[at[cut]] if (cut := v[: secrets.LEARNED + 1]) in at else formats.automata["assign"][0], v)
            for v in {t.split("=", 1)[1].encode() for _, t in rows}
        )
        assert len(taught) <= sample and formats.automata["assign"][1] == pytest.approx(means[306 // 100], abs=1e-12)
