"""Fingerprints, alignment and infilling, against plain Python on the smallest tables and on rows that are odd in every way."""

import collections
import hashlib
import itertools
import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.test_documents import ODD, ROWS

from docwright.llm import alignment, infilling, simhash
from docwright.llm.queries import QUERIES, tokenizer_path
from docwright.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TRICKY = ["a▁b", "<|endoftext|> x", "<s> </s>", "▁", " ", "   ", "a  b ", "x　y", "\n\n a\n", "\U0001f600", "\x00", "it's 1234"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


# -- words ---------------------------------------------------------------------------------

def test_periodic_words_have_different_hashes():
    bits = [0]
    while len(bits) < 4096:
        bits += [1 - b for b in bits]
    first, second = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    hashes, _ = word_hashes(pa.array([first, second, f"{second} {first}"]))
    assert hashes[0] == hashes[3] != hashes[1] == hashes[2]


# -- fingerprints --------------------------------------------------------------------------

def test_edited_texts_and_links(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op11_simhash"](spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    value = {i: int(got[i]["fingerprint"], 16) for i in ids}
    distinct = set(value.values())
    links = {x: sum(0 < (x ^ y).bit_count() <= simhash.RADIUS for y in distinct) for x in distinct}
    assert len(got) == len(ids)
    for at, i in enumerate(ids):
        other = ids[(at + 1) % len(ids)]
        half, row = len(texts[i]) // 2, got[i]
        assert row["n_chars"] == len(texts[i])
        assert row["edited_sha256"] == sha(texts[i][:len(texts[i]) - half] + texts[other][:half])
        assert row["near_edited"] == 1 - (value[i] ^ int(row["edited_fingerprint"], 16)).bit_count() / 128
        assert row["near_next"] == 1 - (value[i] ^ value[other]).bit_count() / 128
        assert row["n_links"] == links[value[i]]
        assert row["class_id"] == min(k for k in ids if value[k] == value[i])
    nearer = [r["near_edited"] > r["near_next"] for r in got.values()]
    assert sum(nearer) > 0.95 * len(nearer)


def test_fingerprint_is_the_sign_of_the_weighted_votes(spark):
    frame = spark.createDataFrame([(1, "one two Two, three"), (2, "two"), (3, "!?"), (4, "two one")], "id long, text string")
    common = simhash.common_terms(frame)
    weights = {r["first"]: r["weight"] for r in common.collect()}
    words = [r["w"] for r in frame.selectExpr("id", "explode(array('one','two','three','!?')) w").where("id = 1").select("w").collect()]
    hashes = {r["w"]: (r["a"], r["b"]) for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) a", "xxhash64(w, 1) b").collect()}
    terms = {1: ["one", "two", "two", "three"], 2: ["two"], 3: ["!?"], 4: ["two", "one"]}
    assert weights[hashes["two"][0]] == 1
    for row in simhash.fingerprints(frame, common, "id").collect():
        for side, name in ((0, "high"), (1, "low")):
            want = 0
            for bit in range(64):
                vote = sum(weights.get(hashes[t][0], simhash.MOST) * (1 if hashes[t][side] >> bit & 1 else -1) for t in terms[row["id"]])
                want |= (vote > 0) << bit
            assert row[name] % (1 << 64) == want


@pytest.mark.parametrize("radius", [2, 6, 7])
def test_block_tables_find_every_pair_within_the_radius(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 16)
    rng, base = random.Random(radius), []
    for _ in range(12):
        centre = rng.getrandbits(128)
        base += [centre ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 5))) for _ in range(10)]
    values = sorted(set(base) | {0, 1, (1 << 128) - 1})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in values], "high long, low long")
    whole = lambda h, low: (h % (1 << 64)) << 64 | low % (1 << 64)
    want = {(x, y) for x, y in itertools.permutations(values, 2) if (x ^ y).bit_count() <= radius}
    found = [(whole(r[0], r[1]), whole(r[2], r[3])) for r in simhash.links(frame, radius).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    counts = {whole(r[0], r[1]): r[2] for r in simhash.link_counts(frame, radius).collect()}
    assert counts == dict(collections.Counter(x for x, _ in want))


def test_no_table_of_fingerprints_is_sent(spark, monkeypatch, tmp_path):
    """The posted rows are many times what Spark takes them for, and so are the sizes of their buckets."""
    kept = {}
    monkeypatch.setattr(simhash, "stored", lambda frame, name: kept.setdefault(name, frame))
    spark.range(100).select(F.xxhash64("id").alias("high"), F.hash("id").cast("long").alias("low")).write.parquet(f"{tmp_path}/prints")
    simhash.link_counts(spark.read.parquet(f"{tmp_path}/prints"))
    plan = kept["simhash-buckets"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_fingerprints_of_odd_rows(spark, odd, none):
    rows = simhash.edited_pairs(odd).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()))
    want = collections.Counter()
    for at, r in enumerate(order):
        text, other = r[1] or "", order[(at + 1) % len(order)][1] or ""
        want[r[0], len(text), sha(text[:len(text) - len(text) // 2] + other[:len(text) // 2])] += 1
    assert bag((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 0}) == 1
    assert simhash.edited_pairs(none).collect() == []
    alone = simhash.edited_pairs(odd.where("doc_id = 4")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


# -- alignment -----------------------------------------------------------------------------

def aligned(rows):
    """What the contract says, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A_PATH)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out, counts, every = [], collections.Counter(), []
    for i, text in rows:
        a, b = (one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)) if text else ([], [])
        bytes_a = [bytes(back[c] for c in one.id_to_token(t)) for t in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(two.id_to_piece, b)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        spans = [[(e - len(t), e, x) for t, e, x in zip(ts, itertools.accumulate(map(len, ts)), ids, strict=True)] for ts, ids in ((bytes_a, a), (bytes_b, b))]
        links = [(x, y) for s, e, x in spans[0] for t, f, y in spans[1] if s < f and t < e]
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        written = [[",".join(str(x) for _, e, x in side if low < e <= high) for side in spans] for low, high in zip([0, *ends], ends, strict=False)]
        counts.update(links)
        every.append(links)
        out.append([i, len(a), len(b), len(ends), len(links), 0, 0, sha(";".join("|".join(g) for g in written)) if a else ""])
    highest = collections.defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    for row, links in zip(out, every, strict=True):
        row[5] = sum(counts[p] == highest[p[1]] for p in links)
        row[6] = sum(counts[p] for p in links)
    return bag(out)


def short_rows(texts):
    rows = [(i, t) for i, t in texts.items() if len(t) < 1500]
    return [*rows, *((1000 + i, t) for i, t in enumerate(TRICKY)), (None, None), (None, "same"), (7, ""), (rows[0][0], rows[0][1])]


@pytest.mark.parametrize("fan", [alignment.FAN, 2])
def test_alignment_against_plain_python(spark, texts, monkeypatch, fan):
    monkeypatch.setattr(alignment, "FAN", fan)
    rows = short_rows(texts)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert bag(alignment.align(frame, A_PATH, B_PATH).collect()) == aligned(rows)


def test_alignment_of_odd_rows(spark, odd, none):
    rows = alignment.align(odd, A_PATH, B_PATH).collect()
    assert len(rows) == len(ROWS)
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in rows)
    assert all((r["groups_sha256"] == "") == (r["n_a"] == 0) for r in rows)
    assert alignment.align(none, A_PATH, B_PATH).collect() == []


def test_merge_of_runs_counts_each_pair():
    rng = np.random.default_rng(5)
    runs, want = [], collections.Counter()
    for size in (0, 1, 70_000, 100_000, 40_000):
        pairs = np.unique(rng.integers(0, 150_000, size)).astype("<u8")
        totals = rng.integers(1, 9, len(pairs)).astype("<u8")
        runs.append(alignment.pack(pairs, totals))
        for p, t in zip(pairs.tolist(), totals.tolist(), strict=True):
            want[p] += t
    got = [(p, t) for pairs, totals in alignment.merged(runs) for p, t in zip(pairs.tolist(), totals.tolist(), strict=True)]
    assert got == sorted(want.items())


# -- infilling -----------------------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 3, 8, 4096])
def test_fenwick_ends_against_plain_python(block):
    rng = random.Random(block)
    for _ in range(60):
        text = "".join(rng.choice("ab\né\U0001f600€") for _ in range(rng.randint(0, 60)))
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        blocks = infilling.Blocks(np.frombuffer(text.encode(), dtype=np.uint8), block)
        assert blocks.n_units == len(units)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert blocks.end_of(k) == (len(before.encode()), len(before))


def infilled(doc_id, text, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h1, h2, h3, h4 = (int(sha(f"7:{'' if doc_id is None else doc_id}")[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infilling_of_odd_rows_and_its_way_back(spark, odd, none):
    tricky = [(100 + i, t) for i, t in enumerate(["<P", "a<S>b", "<<\n<S\n<M\n>", "\n", "\n\n\n", "x\ny", "\r\n a\n", "a\n" * 9000])]
    frame = odd.select("doc_id", "text").union(spark.createDataFrame(tricky, "doc_id long, text string"))
    for rate in (100, 40):
        made = infilling.transform(frame, rate=rate)
        back = made.withColumn("back", infilling.restored(made["output"], made["form"])).collect()
        rows = [(r[0], r[1] or "") for r in ROWS] + tricky
        assert bag(r[:6] for r in back) == bag(infilled(*r, rate=rate) for r in rows)
        assert bag((r["doc_id"], r["back"]) for r in back) == bag(rows)
    assert infilling.transform(none).collect() == []


def test_vocabulary_files_are_what_alignment_expects():
    assert max(json.loads(open(A_PATH, encoding="utf-8").read())["model"]["vocab"].values()) < 1 << 16
