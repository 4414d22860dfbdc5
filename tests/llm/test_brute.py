"""Each operator against a plain version of itself on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from foreledger.llm import (
    decontaminate,
    langid,
    mixing,
    pst,
    rules,
    secrets,
    simhash,
    tokens,
    toxicity,
)
from foreledger.llm.components import components
from foreledger.llm.queries import QUERIES
from foreledger.llm.sql import ORACLE
from tests.conftest import SMALL
from tools.check import compare


def table(name, folder=SMALL):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return sorted(table("documents"), key=lambda r: r["doc_id"])


def answers(spark, name, key="doc_id", folder=SMALL):
    return {r[key]: r for r in QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, db, name):
    text, ok = compare(spark, db, name, QUERIES[name], ORACLE[name], SMALL)
    assert ok, text


def test_rule_ablations(spark, docs):
    policy = rules.POLICIES["v2"]
    rows = rules.ledger(spark.read.parquet(f"{SMALL}/documents.parquet")).cache()
    bits = [r["fail_bits"] & policy.mask for r in rows.collect()]
    got = {r["rule"]: (r["failed"], r["kept_without"]) for r in rules.ablations(rows, policy).collect()}
    want = {n: (sum(bool(b & bit) for b in bits), sum(b == bit for b in bits)) for n, bit in rules.BIT.items()}
    assert {k: v for k, v in want.items() if v[0]} == {k: v for k, v in got.items() if v[0]}
    kept = rules.keep(spark.read.parquet(f"{SMALL}/documents.parquet"), policy)
    assert kept.count() == sum(b == 0 for b in bits)
    assert kept.columns == list(docs[0])


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    parts = parts or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash(spark, docs):
    got = answers(spark, "op3_simhash")
    prints = [plain_fingerprint(r["text"]) for r in docs]
    want = plain_groups(prints)
    for row, fp, first in zip(docs, prints, want, strict=True):
        assert got[row["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert got[row["doc_id"]]["component_id"] == docs[first]["doc_id"]


def test_triples_meet_every_four():
    from itertools import combinations

    assert len(simhash.TRIPLES) == 20
    for four in combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.TRIPLES)


@pytest.mark.parametrize("most", [2, 1000])
def test_links_of_long_lists(spark, most):
    """Chains and clusters of prints a few bits apart, by lists paired up and by shared values."""
    dice = random.Random(3)
    prints = []
    for _ in range(12):
        at = dice.getrandbits(64)
        for _ in range(12):
            prints.append(at)
            for _ in range(dice.choice([1, 3, 4, 6])):
                at ^= 1 << dice.randrange(64)
    want = plain_groups(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r["node"]: r["component"] for r in components(simhash.links(df, most)).collect()}
    got = [found.get(p, p) for p in signed]
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want, strict=True)))


def test_components(spark):
    dice = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(dice.randrange(100, 200), dice.randrange(100, 200)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != r} | {n: r for n, r in got.items() if root[n] == r}


def test_token_ids(spark, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = answers(spark, "op6_token_ids"), 0
    for row in docs:
        ids = [*plain.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        mine = got[row["doc_id"]]
        assert (mine["start"], mine["n_tokens"], mine["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_encoder_is_the_tokenizer():
    coder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["", " ", "It's 42 x_y!! don'T", "É Ünï ß ÿ × ÷", "á b c", "<|endoftext|> x", "İΣς 中文 🙂", "e f\x1fg\x0b"]
    for text, ids in zip(odd, coder.encode(odd), strict=True):
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, coder.dtype).tolist() == want


@pytest.mark.parametrize("n", [0, 1, 5, 4096])
def test_packed_ranks(n):
    dice = np.random.default_rng(n)
    ranks = (dice.integers(0, 1 << 32, n) >> dice.integers(0, 32, n)).astype(np.uint32)
    raw = tokens.pack_file([7, None], [n, 0], ranks)
    ids, lengths, back = tokens.unpack_file(raw)
    assert ids == [7, None] and lengths.tolist() == [n, 0] and np.array_equal(back, ranks)


PLAIN_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in PLAIN_ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(spark, docs):
    got = answers(spark, "op7_secret_scan")
    for row in docs:
        want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(row["text"] or ""))
        assert got[row["doc_id"]]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_secret_patterns():
    texts = [
        "token=key1 api_key : abcdefgh12", "PASSWORD = 'short' secret:longenough", "AKIA12 AKIA" + "A" * 12,
        "ſecret=abcdefghij", "f" * 31 + " " + "f" * 32 + "F", "toKen = aaaaaaaa.bbbb; Passwd:\"x1234567\"",
    ]
    for text in texts:
        assert secrets.base_spans(text) == plain_spans(text)
    assert secrets.finding("x https://me:pass1@host/")[4] == "url_password:2:23"


def test_key_blocks_of_any_text():
    plain = re.compile(
        r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
    )
    rnd = random.Random(2)
    pieces = ["-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "-----END X PRIVATE KEY-----", "a\n", "-----"]
    for _ in range(300):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))
        want = [(m.start(), 3, m.end()) for m in plain.finditer(text)]
        assert secrets.key_blocks(text) == want
    # a text of begin lines, with and without an end
    lines = "-----BEGIN PRIVATE KEY-----\nabc\n" * 100_000
    assert secrets.more_spans(lines) == []
    assert len(secrets.more_spans(lines + "-----END PRIVATE KEY-----")) == 1


def test_secret_ledger_grows(spark, docs):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    first = secrets.scan_unseen(df.where("doc_id < 100"), None, "doc_id", "text").cache()
    rest = secrets.scan_unseen(df, first, "doc_id", "text").cache()
    blobs = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs}
    assert first.count() + rest.count() == len(blobs)
    assert secrets.scan_unseen(df, first.unionByName(rest), "doc_id", "text").count() == 0


def test_warc(spark):
    got, first = answers(spark, "op10_warc", "page_id"), {}
    for row in sorted(table("pages"), key=lambda r: r["page_id"]):
        raw = (row["html"] or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        target = first.get(digest) if len(raw) >= 100 else None
        first.setdefault(digest, row["page_id"])
        mine = got[row["page_id"]]
        kind = "response" if target is None else "revisit"
        assert mine["payload_bytes"] == len(raw) and mine["payload_digest"] == digest
        assert (mine["record_type"], mine["refers_to"]) == (kind, target)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 2, "c": 1, None: 0.5}])
def test_mixing_deviates_less_than_a_block(spark, weights):
    sizes = {"a": 900, "b": 700, "c": 333, None: 40}
    rows = [(i, s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mixed(df, weights).collect()
    assert len({(r["_fl_position"], r["_fl_place"]) for r in got}) == len(rows)
    order = {r["_fl_position"]: (r["source"], r["_fl_block"]) for r in got}
    assert sorted(order) == list(range(len(set(order.values()))))
    weight = weights or {s: math.sqrt(n) for s, n in sizes.items()}
    shares = {s: max(1, round(1000 * w / sum(weight.values()))) for s, w in weight.items()}
    blocks = {s: -(-n // mixing.BLOCK_ROWS) for s, n in sizes.items()}
    ran = Counter()
    for at in range(len(order)):
        if any(ran[s] == blocks[s] for s in sizes):
            break
        ran[order[at][0]] += 1
        for s in sizes:
            assert abs(ran[s] - (at + 1) * shares[s] / sum(shares.values())) < 1
    assert at > 30


def test_language_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = answers(spark, "op2_language_id", folder=folder)
    held = [r for r in table("documents", folder) if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right >= 0.98 * len(held)


def test_code_lengths(spark):
    texts = [("x", "abracadabra abra"), ("x", "cadabra"), ("y", "zzyzx zyx zzz")]
    df = spark.createDataFrame(texts, "lang string, text string")
    model = langid.train(df)
    counts = {}
    for lang, text in texts:
        raw = b"\0\0\0" + text.encode()
        for i in range(3, len(raw)):
            for k in range(4):
                counts.setdefault((lang, raw[i - k : i]), Counter())[raw[i]] += 1

    def plain(lang, context, byte):
        p = 1 / 256
        for k in range(4):
            seen = counts.get((lang, context[3 - k :] if k else b""))
            if seen is None:
                break
            n, d = seen.total(), len(seen)
            p = seen[byte] / (n + d) if byte in seen else d / (n + d) * p
        return p

    raw = b"\0\0\0" + b"zabra q!"
    want = [sum(-math.log2(plain(x, raw[i - 3 : i], raw[i])) for i in range(3, len(raw))) for x in "xy"]
    assert model.bits(raw[3:]) == pytest.approx(want, rel=1e-5)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    got = answers(spark, "op8_toxicity", folder=folder)
    held = [r for r in table("labels", folder) if got[r["doc_id"]]["held_out"]]
    toxic = [got[r["doc_id"]]["predicted"] for r in held if r["toxic"]]
    clean = [got[r["doc_id"]]["predicted"] for r in held if not r["toxic"]]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_label_model_finds_rates():
    dice = np.random.default_rng(0)
    y = dice.random(40_000) < 0.2
    on, off = np.array([0.6, 0.4, 0.3, 0.5]), np.array([0.01, 0.05, 0.02, 0.2])
    votes = dice.random((len(y), 4)) < np.where(y[:, None], on, off)
    both = votes.T.astype(float) @ votes
    seen = np.stack([votes[~y].sum(0), votes[y].sum(0)]).astype(float)
    model = toxicity.fit_label_model(both, len(y), 0.2, seen, int(y.sum()), int((~y).sum()))
    assert model.rate[1] == pytest.approx(on, abs=0.06)
    assert model.rate[0] == pytest.approx(off, abs=0.03)


def test_lm_base_is_exact_and_model_is_better(spark, docs):
    got = answers(spark, "op4_lm_scoring")
    words = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b""] for r in docs}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, own in words.items() if i not in held for w in own)
    n, v = counts.total(), len(counts)
    for i, own in words.items():
        row = got[i]
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(counts[w] > 0 for w in own))
        assert row["train_tokens"] == n and row["held_out"] == (i in held)
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


class PlainTree:
    """The suffix tree over texts, by dictionaries."""

    def __init__(self, texts, divergence=0.5):
        self.n = [Counter(), Counter(), Counter()]
        self.starts = len(texts)
        for words in texts:
            own = [None, *words]
            for i in range(1, len(own)):
                for size in (1, 2, 3):
                    if i + 1 - size >= (0 if size > 1 else 1):
                        self.n[size - 1][tuple(own[i + 1 - size : i + 1])] += 1
        self.total, self.distinct = self.n[0].total(), len(self.n[0])
        self.states = set()
        every = [{c for g in self.n[k] if self.seen(c := g[:-1]) >= pst.LEAST_SEEN} for k in (1, 2)]
        self.may, told = every[0] | every[1], Counter()
        for k in (1, 2):
            for gram, n in self.n[k].items():
                seen = self.seen(gram[:-1])
                if seen >= pst.LEAST_SEEN:
                    below = self.p(gram[1:-1], gram[-1], self.may)
                    one = math.log(n / (seen * below)) - divergence * math.log(seen + 1) / n
                    told[gram[:-1]] += n * round(one * pst.UNIT)
        self.states = {c for c in told if told[c] >= 0}

    def seen(self, context):
        return self.starts if context == (None,) else self.n[len(context) - 1][context]

    def p(self, context, word, states=None):
        if not context:
            return (self.n[0][(word,)] + 1) / (self.total + self.distinct + 1)
        below = self.p(context[1:], word, states)
        if context not in (self.states if states is None else states):
            return below
        weight = pst.SMOOTHING[len(context) - 1]
        return (self.n[len(context)][(*context, word)] + weight * below) / (self.seen(context) + weight)

    def score(self, words):
        own = [None, *words]
        return sum(math.log10(self.p(tuple(own[max(0, i - 2) : i]), own[i])) for i in range(1, len(own)))


@pytest.mark.parametrize("portion", [None, 3000])
def test_lm_score_is_that_of_the_plain_tree(spark, docs, monkeypatch, portion):
    if portion:  # many portions and buckets
        monkeypatch.setattr(pst, "PORTION_BYTES", portion)
        monkeypatch.setattr(pst, "BUCKET_BYTES", 5 * portion)
    got = answers(spark, "op4_lm_scoring")
    words = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b""] for r in docs}
    tree = PlainTree([own for i, own in words.items() if not got[i]["held_out"]])
    assert {len(c) for c in tree.states} == {1, 2} and tree.states < tree.may
    for i, own in words.items():
        assert got[i]["score"] == pytest.approx(tree.score(own), rel=1e-6), i


def test_tree_is_a_distribution():
    lines = ["the cat sat on the mat", "the cat ate", "the dog sat on the cat"] * 40
    tree = PlainTree([[*x.encode().split(), b""] for x in lines])
    words = [w for (w,) in tree.n[0]]
    assert any(len(c) == 2 for c in tree.states)
    for before in [(), (b"the",), (b"the", b"cat"), (None,), (None, b"the"), (b"no",), (b"no", b"the")]:
        assert sum(tree.p(before, w) for w in [*words, b"unknown"]) == pytest.approx(1)


def test_lm_tells_texts_that_occur_twice(spark, tmp_path):
    """However rare its words, a text that repeats scores above one that does not."""
    dice = random.Random(11)
    lines = [" ".join(f"w{dice.randrange(5000)}" for _ in range(60)) for _ in range(300)]
    rows = [(i, x) for i, x in enumerate([*lines, *lines[:20]])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    from pyspark.sql import functions as F

    score = {r["doc_id"]: r["score"] - r["base_score"] for r in pst.scored(df, F.lit(True), F.col("doc_id")).collect()}
    twice = {*range(20), *range(300, 320)}
    assert min(score[i] for i in twice) > max(score[i] for i in score if i not in twice)


def test_words_of_odd_texts():
    odd = [" a  B\x0bc\x1cd\x85e ", None, "", "\t\n", "\u00c4x \u00a0 y\u2003z Q", "\r\nlast"]
    got, sizes = pst.symbols_of(pa.chunked_array([odd[:2], odd[2:]], pa.string()))
    words = [[*(x or "").encode().lower().split(), b""] for x in odd]
    assert sizes.tolist() == [len(own) for own in words]
    assert got.tolist() == [pst.hashed(w) for own in words for w in own]


def test_places_in_a_sorted_table():
    dice = np.random.default_rng(3)
    keys = np.frombuffer(dice.bytes(8 * 5000), "<u8") >> np.uint64(14)
    for size in (0, 1, 2, 3000):
        table = np.sort(keys[:size])
        place, there = pst.place_in(table, keys, 50)
        assert there.sum() == size and (table[place[there]] == keys[there]).all()


def test_packed_keys_come_back():
    dice = np.random.default_rng(2)
    keys = np.unique(np.frombuffer(dice.bytes(8 * 999), "<u8"))
    assert (pst.unpacked_keys(pst.packed_keys(keys)) == keys).all()
    numbers = np.array([0, -1, 5, -(1 << 40), 1 << 62])
    assert (pst.unpacked(pst.packed(numbers)) == numbers).all()


def test_packed_numbers_take_little_room():
    """Keys cost what their spread tells, small numbers of either sign no more than they are wide."""
    dice = np.random.default_rng(5)
    keys = np.unique(dice.integers(0, 1 << 42, 27_000, dtype=np.uint64))
    told = 42 - np.log2(len(keys)) + np.log2(np.e)
    assert len(pst.packed_keys(keys)) * 8 < 1.02 * told * len(keys)
    sums = np.rint(dice.normal(0, 300, 14_000)).astype(np.int64)
    assert len(pst.packed(sums)) < 1.4 * len(sums)
    for some in (keys[:0], keys[:1], keys):
        assert (pst.unpacked_keys(pst.packed_keys(some)) == some).all()
    ends = np.array([-(1 << 63), (1 << 63) - 1, -1, 0])
    for some in (sums, sums[:0], ends):
        assert (pst.unpacked(pst.packed(some)) == some).all()


def test_near_passages_are_found(spark):
    """Windows with words changed: what brute force over all windows finds is found."""
    dice = random.Random(5)
    items = [(i, " ".join(f"w{dice.randrange(3000)}" for _ in range(dice.choice([9, 20, 45])))) for i in range(30)]
    rows = []
    for d in range(90):
        inner = items[d % 30][1].split()
        for _ in range(d // 30):
            inner[dice.randrange(len(inner))] = f"x{d}"
        around = [f"u{dice.randrange(3000)}" for _ in range(40)]
        rows.append((d, " ".join([*around[:20], *inner, *around[20:]])))

    def grams(words):
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    want = {}
    for d, text in rows:
        words = text.split()
        for i, item in items:
            own = grams(item.split())
            size = len(item.split())
            best = 0.0
            for at in range(len(words) - size + 1):
                window = grams(words[at : at + size])
                best = max(best, (own & window).total() / (own | window).total())
            if best >= 0.8:
                want[d, i] = best
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.passages(docs, bench).collect()}
    assert got == pytest.approx(want) and len(want) >= 30


def test_documents_shorter_than_the_item(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:55])), (2, " ".join(words[:40])), (3, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    found = decontaminate.passages(docs, bench).collect()
    got = {r["doc_id"]: (r["window_start"], r["shared"], r["similarity"]) for r in found}
    assert got == {1: (0, 51, pytest.approx(51 / 56)), 3: (0, 56, 1.0)}
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_passages_of_repeated_shingles(spark):
    """A run of one word on one side: the multiset similarity decides, not the fingerprint's weights."""
    dice = random.Random(8)
    items, rows, want = [], [], {}
    for i in range(40):
        size = 120 if i % 2 else 160
        words = [f"w{dice.randrange(10**6)}" for _ in range(size)]
        items.append((i, " ".join([*words, *[f"y{i}.{k}" for k in range(14)]])))
        rows.append((i, " ".join([*words, *["0"] * 14])))
        want[i, i] = (size - 4) / (size + 24)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.passages(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == pytest.approx(want)
    turned = decontaminate.passages(bench.toDF("doc_id", "text"), docs.toDF("item_id", "text"))
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in turned.collect()} == pytest.approx(want)


def test_toxic_terms_beyond_the_sample(spark, monkeypatch):
    """Terms, rates and prior come from all labelled texts, also when the classifier's sample is small."""
    rows = [(i, f"plain words {i % 7} about number{i}" + (" zorgle" if i % 10 == 0 else "")) for i in range(600)]
    rows += [(3, "another text")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(600)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE", 2)
    given = []
    fit = toxicity.fit_label_model

    def spy(both, texts, prior, with_label, toxic, clean):
        given.append((toxic, clean, prior))
        return fit(both, texts, prior, with_label, toxic, clean)

    monkeypatch.setattr(toxicity, "fit_label_model", spy)
    model = toxicity.train(docs, labels)
    assert given == [(60, 541, pytest.approx(60 / 601))]
    assert "zorgle" in model.weight and model.weight["zorgle"] > 0
