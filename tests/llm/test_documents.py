"""Operators on documents, against brute force on the smallest tables, and on rows that are odd in every way."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docwright.llm import decontamination, language_model, near_duplicates, packing, pii, quality, sharding
from docwright.llm.queries import tokenizer_path
from docwright.llm.tokens import coder
from docwright.llm.words import shingle_sets

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
ODD = "doc_id long, text string, row string, score double, class_id string, bucket string, kind int, size string"
ROWS = [
    (1, None, "r", 1.0, "a", "b", 1, "s"), (2, "", None, None, None, None, None, None), (None, "one two three", "r", None, "a", None, 2, None),
    (3, "Same words Here again and Again 4111 1111 1111 1111", "r", 0.5, None, "b", None, "s"), (3, "Same words Here again and Again 4111 1111 1111 1111", "r", 0.5, None, "b", None, "s"),
    (4, "same words here AGAIN and again 4111 1111 1111 1111", None, None, None, None, None, None), (5, LONG, None, None, None, None, None, None), (6, LONG + " end", None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None), (7, "  \n\t ", None, None, None, None, None, None), (8, "😀 naïve <|endoftext|> ß a@b.co 1.2.3.4 999.1.1.1", None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = words(text)
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else {tuple(w)} if w else set()


def test_shingle_sets_count_like_plain_python(texts):
    every = [*texts.values(), *(r[1] for r in ROWS)]
    assert [len(s) for s in shingle_sets(pa.array(every, pa.string()), 5)] == [len(shingles(t)) for t in every]


def test_near_duplicates_against_all_pairs(documents, texts):
    sets, parent = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r["doc_id"]: r for r in near_duplicates.near_duplicates(documents).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == {k: root(k) for k in texts}
    assert all(r["kept"] == (k == root(k)) and r["n_shingles"] == len(sets[k]) for k, r in got.items())


def test_near_copies_that_no_first_class_joins(spark):
    """Copies with three edits are linked with the original's other copies only through it; blocks must find what stars miss."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for n in range(60):
        own = list(base)
        for at in rng.choice(150, n % 5, replace=False):
            own[at] = f"x{n}_{at}"
        rows.append((n, " ".join(own)))
    sets, parent = [shingles(t) for _, t in rows], list(range(60))
    root = lambda x: x if parent[x] == x else root(parent[x])
    for a in range(60):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {n: root(n) for n in range(60)}


def test_near_duplicates_of_odd_rows(odd, none):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(odd).collect()), key=str)
    by = collections.defaultdict(list)
    for r in got:
        by[r[0]].append(r[1:])
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[7] == [(0, 7, True)]
    assert len(by[3]) == 2 and {r[1] for r in by[3] + by[4]} == {3} and [r[2] for r in by[4]] == [False]
    assert by[5][0][1] == by[6][0][1] == 5 and len(by[None]) == 2 and len(got) == len(ROWS)
    assert near_duplicates.near_duplicates(none).collect() == []


def test_pieces_pack_and_match_the_library(documents, texts, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(documents, tokenizer_path()).collect()
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, text in texts.items():
        ids, at = np.array([*library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4"), 0
        for n, r in enumerate(sorted(by[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and (len(by[k]) == 1 or all(r["length"] == 1024 for r in by[k] if r["piece"]))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    few = packing.pack(odd, tokenizer_path()).collect()
    assert len([r for r in few if r["length"] == 1 and r["piece"] == 0]) == 3 and len({(r["sequence_id"], r["offset"]) for r in few}) == len(few)
    assert packing.pack(none, tokenizer_path()).collect() == []


def test_pieces_of_any_signs():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rng, signs = np.random.default_rng(0), list(" \n\t'  abcstvreldm19.,!é日本 😀<|>\r'´ª²½")
    some = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)] + ["", "it's we're 'sand ''s I'll 'd\n\n x \n"]
    end = "<|endoftext|>"
    some += [f"hello {end} world", end, end * 3, f"a  {end}  b\n{end}", f"<|endoftext{end}|>"] + [a + end + b for a, b in zip(some[:300], some[300:600], strict=True)]
    ids, borders = coder(tokenizer_path()).encode_with_added(pa.array(some))
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:], strict=True)] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_plan_uses_every_piece_and_beats_plain_best_fit():
    rng = np.random.default_rng(1)
    for top in (100, 400, 1024):
        lengths = collections.Counter(rng.integers(1, top, 3000).tolist())
        plan = packing.plan(dict(lengths))
        used = collections.Counter()
        for pattern, times in plan:
            assert sum(pattern) <= 1024 and times > 0
            for n in pattern:
                used[n] += times
        assert used == lengths and sum(t for _, t in plan) <= 1.01 * sum(t for _, t in packing.best_fit(dict(lengths), 1024))


def test_items_against_plain_containment(spark, documents, texts, odd, none):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = set()
    for r in benchmark.collect():
        item = shingles(r["text"], min(5, max(1, len(words(r["text"])))))
        for k, text in texts.items():
            found = len(item & shingles(text))
            if item and 100 * found >= 80 * len(item):
                expected.add((k, r["item_id"], len(item), found))
    got = {tuple(r)[:4] for r in decontamination.find_items(documents, benchmark).collect()}
    assert got == expected and got
    assert {tuple(r)[:4] for r in decontamination.find_items(documents, benchmark, index_bytes=20_000).collect()} == expected
    assert decontamination.without_items(documents, benchmark).count() == len(texts) - len({k for k, *_ in expected})
    items = spark.createDataFrame([(1, "words HERE again"), (2, None), (3, ""), (None, "two three"), (1, "words HERE again")], "item_id long, text string")
    assert sorted(tuple(r)[:2] for r in decontamination.find_items(odd, items).collect() if r["doc_id"]) == [(3, 1), (3, 1), (4, 1)]
    assert decontamination.find_items(none, items).count() == 0 and decontamination.find_items(odd, items.limit(0)).count() == 0
    kept = decontamination.without_items(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) - 4


def test_a_short_item_in_a_very_long_text(spark):
    item = " ".join(f"rare{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{LONG} {item} {LONG}"), (2, LONG), (3, f"{LONG} {' '.join(item.split()[:10])} {LONG}")], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [(r["doc_id"], r["found"]) for r in decontamination.find_items(docs, items).collect()] == [(1, 8)]


def test_quality_on_held_out_labels(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).collect()}
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    few = spark.createDataFrame([(3, 1), (3, 0), (4, 1), (5, None), (None, 1)], "doc_id long, quality int")
    rows = quality.classify(odd, few).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert len(quality.classify(odd, few.limit(0)).collect()) == len(ROWS) and quality.classify(none, few).collect() == []
    assert quality.accepted(odd, few).columns == odd.columns


def test_language_model_against_plain_python(documents, texts, odd, none):
    end, start = "\0END", "\0START"
    tokens = {k: [*words(t), end] for k, t in texts.items()}
    training = {k for k in tokens if zlib.crc32(str(k).encode()) % 7 != 2}
    count = collections.Counter(w for k in training for w in tokens[k])
    pairs = collections.Counter(p for k in training for p in zip([start, *tokens[k][:-1]], tokens[k], strict=True))
    total, different = sum(count.values()), len(count)
    context, before = collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (v, w), n in pairs.items():
        context[v][0] += n
        context[v][min(n, 3)] += 1
        before[w] += 1
    first, second = ([0.0, *language_model.discounts(*[sum(x == k for x in c.values()) for k in range(1, 5)])] for c in (pairs, before))
    mass, every = sum(second[min(n, 3)] for n in before.values()), sum(before.values())

    def p(v, w):
        alone = (before[w] - second[min(before[w], 3)] + mass / (different + 1)) / every
        if v not in context:
            return alone
        n, c = pairs.get((v, w), 0), context[v]
        return (n - first[min(n, 3)] + sum(first[k] * c[k] for k in (1, 2, 3)) * alone) / c[0]

    got = {r["doc_id"]: r for r in language_model.score(documents).collect()}
    for k, t in tokens.items():
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(count[w] > 0 for w in t), total, k not in training)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (total + different + 1)) for w in t), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(v, w)) for v, w in zip([start, *t[:-1]], t, strict=True)), rel_tol=1e-9)
    assert math.isclose(sum(p(end, w) for w in count) + p(end, "\0unknown"), 1.0, rel_tol=1e-9)
    few = language_model.score(odd).collect()
    assert len(few) == len(ROWS) and all(r["score"] <= 0 for r in few) and language_model.score(none).collect() == []


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_against_plain_rules(spark, documents, texts, odd, none):
    rng, signs = np.random.default_rng(2), list("aZ09@@..-+ ()😀é_%4111 ")
    hard = ["".join(rng.choice(signs, rng.integers(0, 80))) for _ in range(1500)]
    hard += ["a@b.com_x@y.org a@b@c.de", "1.2.3.4.5.6.7.8 01.002.3.255", "4111-1111 1111 1111 " * 30, "+1 (017) 555-7713 +44 20 7946 0958", "9" * 5000, "a." * 3000 + "@b.c", None, ""]
    frame = spark.createDataFrame([(10_000 + n, t) for n, t in enumerate(hard)], "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    every = texts | {10_000 + n: t or "" for n, t in enumerate(hard)}
    for r in pii.find(frame).select("doc_id", pii.written(pii.F.col("base")).alias("base")).collect():
        assert r["base"] == base_spans(every[r["doc_id"]]), every[r["doc_id"]]
    few = pii.find(odd, keep_rows=True)
    assert few.count() == len(ROWS) and pii.find(none).count() == 0
    clean = few.select("row.doc_id", pii.redacted(pii.F.col("row.text"), pii.F.col("spans")).alias("text")).collect()
    assert {r["text"] for r in clean if r["doc_id"] in (3, 8)} == {"Same words Here again and Again [CARD]", "😀 naïve <|endoftext|> ß [EMAIL] [IP] 999.1.1.1"}


def test_patterns_find_identifiers_that_no_rule_knows(spark):
    seeds = [(n, f"text about nothing much, mail person{n}@site.org and more") for n in range(6)]
    more = [(10, "nothing else, mail person77(at)site.org here"), (11, "in the year 12345 nothing"), (12, "nobody lost 98765-1 today, mail 55555-12 now"), (13, "again 55555-12 alone")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find(spark.createDataFrame(seeds + more, "doc_id long, text string")).collect()}
    assert got[12] == [("email", 32, 40)] and got[13] == [("email", 6, 14)] and got[11] == [] and all(len(got[n]) == 1 for n in range(6))


def test_found_identifiers_induce_patterns_of_their_own(spark):
    texts = [f"mail person{n}@site.org" for n in range(24)] + [f"mail 5000{n}-00" for n in range(4)]
    for level, word in enumerate(["ref", "case", "file", "code", "item"]):
        texts += [f"{word} 5000{n}-0{level}" for n in range(4)] * 3 + [f"{word} 5000{n}-0{level + 1}" for n in range(4)]
    texts += [f"unrelated 7000{n}-00" for n in range(5)] + ["alone 50001-05"]
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if not r["spans"]} == {n for n, t in enumerate(texts) if t.startswith("unrelated")}


def test_the_word_before_comes_from_the_text(spark):
    row = pii.scan(spark.createDataFrame([(1, "ref (77777-12) 88888-13 a@b.org c@d.org, 99999-14")], "doc_id long, text string")).first()
    assert [(s["value"], s["left"]) for s in row["base"] + row["unseen"]] == [
        ("a@b.org", "88888-13"), ("c@d.org", "a@b.org"), ("77777-12", ""), ("88888-13", "(77777-12)"), ("99999-14", "c@d.org,")]


def test_shards_against_all_rows(documents, texts, odd, none):
    got = sharding.shard(documents, 8).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {k: (len(t.encode()) + 8, zlib.crc32(t.encode())) for k, t in texts.items()}
    sizes, slots, largest = collections.Counter(), collections.defaultdict(list), max(r["size"] for r in got)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(n - mean) <= largest + 0.01 * mean for n in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    few = sharding.shard(odd).collect()
    assert len(few) == len(ROWS) and {r["law"] for r in few} == {"bytes"} and sharding.shard(none).collect() == []
    again = sharding.shard(documents, 8, bucket_bytes=10_000).collect()
    assert sorted((r["shard"], r["doc_id"]) for r in again) == sorted((r["shard"], r["doc_id"]) for r in got)
    assert len({(r["shard"], r["slot"]) for r in again}) == len(again)


def test_shards_hold_the_documents_themselves(spark):
    rows = [(n, f"text {n % 50} " * 9 if n % 7 else None, f"place {n}") for n in range(300)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, origin string"), 4).collect()
    assert sorted(((r["doc_id"], r["text"], r["origin"]) for r in got), key=lambda r: r[0]) == rows
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 for r in got) and {r["shard"] for r in got} == {0, 1, 2, 3}


def test_a_hot_text_is_cut_between_shards(spark):
    rows = [(n, "the same text in a third of all rows " * 3) for n in range(400)] + [(1000 + n, f"text {n} " * 12) for n in range(800)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.02 * sum(sizes.values()) / 6 and len(got) == 1200


def test_a_row_repeated_in_half_of_the_table_is_spread(spark):
    rows = [(k, "ab" + "x" * (k % 23)) for k in range(2400)] + [(7, "the same row again")] * 2400
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    loads, mean = collections.Counter(), sum(len(t) + 8 for _, t in rows) / 24
    for r in got:
        loads[r["shard"]] += r["size"]
    assert len(got) == len(rows) and len(loads) == 24 and all(abs(n - mean) <= 0.01 * mean + 33 for n in loads.values())
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(k for k, _ in rows)
    for shard in range(24):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_digest_of_written_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
