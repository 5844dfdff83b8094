"""Encoding, statistics, near copies, personal data, mixing and repeats against plain Python."""
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as se
import llm_plain as plain
from llm_fixtures import edge_dir, empty_dir, table  # noqa: F401
from tidemark.llm import byte_bpe, hyperminhash, mixing, pii, quality_rules, suffix_dedup, token_store
from tidemark.llm.pieces import PieceEncoder
from tidemark.llm.textcols import flat

SMALL = "/root/testdata/sf0.001"
Q = se.queries()


@pytest.fixture(params=["edge", "small"])
def root(request, edge_dir):
    return edge_dir if request.param == "edge" else SMALL


def result(spark, name, root):
    return [r.asDict() for r in Q[name](spark, root).collect()]


def same_rows(got, expected):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def word_ids(text):
    global _WORDS
    if "_WORDS" not in globals():
        with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
            _WORDS = token_store.load_tokenizer(f.read())
    return _WORDS.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_store(spark, root):
    got = result(spark, "op1_token_store", root)
    docs = table(spark, root, "documents")
    assert len(got) == len(docs)
    ids = collections.defaultdict(list)
    for d in docs:
        t = word_ids(d["text"])
        ids[d["doc_id"]].append((len(t), zlib.crc32(np.array(t, "<u4").tobytes())))
    have = collections.defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in ids.items()} == {k: sorted(v) for k, v in have.items()}
    at, last = 0, None
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        now = (r["doc_id"] is not None, r["doc_id"] or 0)
        assert last is None or now >= last
        at, last = at + r["n_tokens"], now


def test_token_store_single_documents(spark, edge_dir, tmp_path):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    token_store.write(docs, str(tmp_path / "store"))
    some = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_store.read(spark, str(tmp_path / "store"), [6, 17, 99]).collect()}
    texts = {d["doc_id"]: d["text"] for d in table(spark, edge_dir, "documents")}
    assert some == {6: word_ids(texts[6]), 17: word_ids(texts[17])}
    stored = spark.read.parquet(str(tmp_path / "store/dictionary")).first()
    assert {r.dictionary for r in spark.read.parquet(str(tmp_path / "store/shards")).collect()} == {stored.hash}


def rank_encoding():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, root):
    _, encoding = rank_encoding()
    expected = []
    for d in table(spark, root, "documents"):
        ids = encoding.encode_ordinary(d["text"] or "")
        expected.append((d["doc_id"], len(ids), plain.sha(np.array(ids, "<u4").tobytes()), plain.sha((d["text"] or "").encode())))
    same_rows([tuple(r.values()) for r in result(spark, "op5_byte_bpe", root)], expected)


def test_byte_bpe_random_strings():
    ranks, encoding = rank_encoding()
    tokenizer = byte_bpe.build_tokenizer(ranks)
    encoder = PieceEncoder(tokenizer, offsets=True)
    rng = random.Random(1)
    pool = ["a", "A", "é", "Ü", " ", "  ", "\n", "\r\n", "\u0085", " ", "　", "'s", "'", "ll", "1", "½", ".", ",", "|", "😀", "日本",
            "́", "​", "\x00", "\x1c", "×", "÷", "-", "<|endoftext|>", "aaaa", "İ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    ids, counts, spans = encoder.encode(*flat(pa.array(texts)))
    at = 0
    for t, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == encoding.encode_ordinary(t)
        assert [tuple(s) for s in spans[at:at + n].tolist()] == tokenizer.encode(t, add_special_tokens=False).offsets
        at += n


def test_byte_bpe_split_characters(spark):
    """Ids cut inside a character: bytes stay exact, text shows the part as U+FFFD."""
    df = byte_bpe.encode(spark.createDataFrame([(1, "x 日")], "doc_id long, text string"), offsets=True)
    row = df.first()
    assert len(row.token_starts) == len(row.token_ends) == row.n_tokens
    cut = df.withColumn("ids", F.substring("ids", 1, F.length("ids") - 4))
    back = byte_bpe.decode(cut).first()
    assert "x 日".encode().startswith(bytes(back.bytes))
    assert back.decoded_text == bytes(back.bytes).decode("utf-8", "replace")
    with pytest.raises(Exception, match="vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(bytearray(b"\xff\xff\xff\x00"),)], "ids binary")).collect()


def test_quality_rules(spark, root):
    got = result(spark, "op2_quality_rules", root)
    expected = []
    for d in table(spark, root, "documents"):
        s = plain.base_statistics(d["text"])
        expected.append((d["doc_id"], *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
    same_rows([(r["doc_id"], *[r[c] for c in quality_rules.BASE], r["base_failed"]) for r in got], expected)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(quality_rules.FEATURES)))
    y = (x[:, 2] + 0.5 * x[:, 0] ** 2 + 0.3 * rng.normal(size=3000) < 0.8).astype(float)
    monotone = np.array([quality_rules.MONOTONE.get(f, 0) for f in quality_rules.FEATURES])
    trees = quality_rules.grow(x[:2000], y[:2000], monotone)
    assert ((trees.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9
    line = np.repeat(x[2000:2100], 50, axis=0)
    line[:, 2] = np.tile(np.linspace(-4, 4, 50), 100)
    assert (np.diff(trees.score(line).reshape(100, 50), axis=1) <= 1e-12).all()
    # The flattened walk equals a walk node by node.
    for row in x[:20]:
        raw = trees.bias
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            raw += trees.value[at]
        assert abs(1 / (1 + np.exp(-raw)) - trees.score(row[None])[0]) < 1e-12


def test_quality_rules_held_out(spark):
    got = {r["doc_id"]: r for r in result(spark, "op2_quality_rules", "/root/testdata/sf0.01")}
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    good = [got[x["doc_id"]] for x in labels if x["quality"] == 1 and not got[x["doc_id"]]["base_failed"]]
    bad = [got[x["doc_id"]] for x in labels if x["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.2 * len(bad)


def test_near_duplicates(spark, root):
    got = result(spark, "op3_hyperminhash", root)
    docs = table(spark, root, "documents")
    by_id = collections.defaultdict(set)
    for d in docs:
        by_id[d["doc_id"]].add(plain.shingles(d["text"], 3))
    single = {i: next(iter(s)) for i, s in by_id.items() if len(s) == 1 and i is not None}
    component = plain.components(single, 85)
    for r in got:
        if r["doc_id"] in single:
            assert r["n_shingles"] == len(single[r["doc_id"]])
            assert (r["component_id"], r["kept"]) == (component[r["doc_id"]], component[r["doc_id"]] == r["doc_id"])
        elif r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
    assert len(got) == len(docs)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A group of near copies, more than one block holds, has no link lost."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(120)] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(3 + i))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == plain.components({i: plain.shingles(t, 3) for i, t in rows}, 85)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_apart_from_the_largest_part(spark, monkeypatch, seed):
    """Groups whose documents are linked only through others, in other blocks: no connection is lost."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    monkeypatch.setattr(hyperminhash, "PIVOTS", 1)
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    rows, words = [], list(base)
    for i in range(80):  # each a step from an earlier one, so that similarities straddle the threshold
        if i % 10 == 0:
            words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(150)] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    expected = plain.components({i: plain.shingles(t, 3) for i, t in rows}, 85)
    across = []
    inner = hyperminhash._across_blocks
    monkeypatch.setattr(hyperminhash, "_across_blocks", lambda *a: across.append(1) or inner(*a))
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == expected and across and len(set(expected.values())) > 1


def test_near_duplicates_of_a_template(spark, monkeypatch):
    """20,000 near copies are one group of many blocks, whose rows grow with the group; none is left apart."""
    n = 20_000
    rng = random.Random(6)
    base = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80))
    counted = []
    within, apart = hyperminhash._within_blocks, hyperminhash._apart
    monkeypatch.setattr(hyperminhash, "_within_blocks", lambda *a: counted.append(within(*a)) or counted[-1])
    monkeypatch.setattr(hyperminhash, "_apart", lambda *a: counted.append(apart(*a)) or counted[-1])
    df = spark.range(n, numPartitions=4).selectExpr("id as doc_id", f"concat('{base} v', id) as text")
    got = hyperminhash.near_duplicates(df, 3, 85)
    assert [tuple(r) for r in got.groupBy("component_id").count().collect()] == [(0, n)]
    # Bands may gather a document around several hubs; all pairs of 79 blocks would be 79 rows for each.
    assert n <= counted[0].count() <= 2 * n
    assert counted[1].count() == 0


def test_near_duplicates_of_repeated_rows(spark):
    """One row some thousand times is one document of its block; texts that share a doc_id aren't linked by it."""
    rng = random.Random(12)
    a, b, c = ([f"w{rng.randint(0, 10**6)}" for _ in range(60)] for _ in range(3))
    near = lambda x: " ".join(x[:-1] + ["end"])
    rows = [(1, " ".join(a))] * 2000 + [(2, near(a)), (5, near(b)), (5, " ".join(c)), (3, " ".join(b)), (7, near(c))]
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()
    assert collections.Counter((r.doc_id, r.component_id, r.kept) for r in got) == {
        (1, 1, True): 2000, (2, 1, False): 1, (5, 3, False): 1, (3, 3, True): 1, (5, 5, True): 1, (7, 5, False): 1}


def test_bands_miss_rarely():
    for t in (0.8, 0.85, 0.9):
        bands, rows = hyperminhash.bands_for(t)
        assert bands * rows <= hyperminhash.BUCKETS and (1 - t**rows) ** bands <= hyperminhash.MISS


def test_estimates_are_near():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    for share in (0.0, 0.5, 0.85, 1.0):
        n = 1500
        common = int(2 * n * share / (1 + share))
        a, b = np.unique(pool[:n]), np.unique(np.r_[pool[:common], pool[2000:2000 + n - common]])
        regs = [hyperminhash.registers(x) for x in (a, b)]
        e = hyperminhash.estimates(np.stack([r[0] for r in regs]), np.stack([r[1] for r in regs]), np.array([len(a), len(b)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(e[0, 1] - true) < 0.15


def test_personal_data(spark, root):
    expected = []
    for d in table(spark, root, "documents"):
        spans = plain.base_spans(d["text"])
        n = collections.Counter(s[0] for s in spans)
        expected.append((d["doc_id"], n["email"], n["ip"], n["card"], n["phone"],
                         plain.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode())))
    got = result(spark, "op8_pii", root)
    same_rows([tuple(r[c] for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) for r in got], expected)


def test_personal_data_further_kinds_and_redaction(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 ok", "IBAN DE89 3704 0044 0532 0130 01 bad", "my ssn is 123-45-6789", "part 123-45-6789",
        "visa card 378282246310005", "serial 378282246310005", "a@b.co, c@d.co; 4111111111111111@x.com 1.2.3.4", None, "", "none",
        "é😀 mail é@b.co x@b.co"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: [(s.kind, s.start, s.end) for s in r.pii] for r in pii.find(df).collect()}
    assert [s[0] for s in got[0]] == ["iban"] and got[1] == []
    assert [s[0] for s in got[2]] == ["national_id"] and got[3] == []
    assert [s[0] for s in got[4]] == ["short_card"] and got[5] == []
    assert got[10] == [("email", 15, 21)]
    red = {r.id: r.text for r in pii.redact(df).collect()}
    assert red[2] == "my ssn is [NATIONAL_ID]" and red[7] is None and red[8] == "" and red[9] == "none"
    assert red[6] == "[EMAIL], [EMAIL]; [EMAIL] [IP]"
    assert red[10] == "é😀 mail é@b.co [EMAIL]"


def test_personal_data_many_spans(spark):
    """More matches than one chunk of running sums, and long runs without a match."""
    text = " ".join(f"u{i}@h{i}.org" for i in range(700)) + " " + "a" * 50_000 + " " + "1" * 20_000 + " " + "a." * 20_000
    row = pii.find(spark.createDataFrame([(text,)], "text string")).first()
    assert [(s.kind, s.start, s.end) for s in row.pii if s.kind in pii.BASE] == plain.base_spans(text)


def test_token_store_of_another_vocabulary(spark, edge_dir, tmp_path):
    """A file that keeps case, or splits otherwise, isn't read piece by piece; its ids are the library's too."""
    import json
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        known = f.read()
    assert token_store.reads_words(known)
    other = json.loads(known)
    other["normalizer"] = {"type": "NFC"}
    other["pre_tokenizer"]["pretokenizers"][0]["behavior"] = "Isolated"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    assert not token_store.reads_words(path.read_bytes())
    tokenizer = token_store.load_tokenizer(path.read_bytes())
    docs = [d for d in table(spark, edge_dir, "documents") if len(d["text"] or "") < 10_000]
    store = str(tmp_path / "store")
    token_store.write(spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string"), store, str(path))
    got = [(r.doc_id, bytes(r.ids)) for r in token_store.read(spark, store).collect()]
    expected = [(d["doc_id"], np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for d in docs]
    same_rows(got, expected)


def test_two_stores_of_one_table_share_their_dictionary(spark, tmp_path):
    """Rows in another order and a doc_id with many texts: the sample is the same, and reaches into long documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.selectExpr("CAST(7 AS BIGINT) AS doc_id", "text"))
    hashes = set()
    for i, df in enumerate((docs, docs.orderBy(F.desc("text")).repartition(7))):
        token_store.write(df, str(tmp_path / str(i)))
        hashes |= {r.hash for r in spark.read.parquet(str(tmp_path / str(i) / "dictionary")).collect()}
    assert len(hashes) == 1


def test_personal_data_in_a_list_of_addresses(spark):
    """20,000 addresses (and as many numbers) in one text, in seconds; overlapping spans and texts of several blocks redacted."""
    import time
    lines = [f"é{i} 😀 u{i}@h{i}.org, +1 (202) 555-{i:05d}" for i in range(20_000)]
    text = "\n".join(lines)
    df = spark.createDataFrame([(text,), ("a@b.co",), (None,)], "text string")
    started = time.time()
    rows = {r.text: r.pii for r in pii.find(df).collect()}
    took = time.time() - started
    assert [(s.kind, s.start, s.end) for s in rows[text] if s.kind in pii.BASE] == plain.base_spans(text)
    assert took < 90, took
    red = [r.text for r in pii.redact(df).collect()]
    assert red == ["\n".join(f"é{i} 😀 [EMAIL], [PHONE]" for i in range(20_000)), "[EMAIL]", None]


def test_what_stands_before_each(spark):
    rng = random.Random(2)
    rows = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 255, 256, 257, 1000)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<int>")
    df = df.select("i", "a", pii.chunked(F.col("a")).alias("c"))
    got = df.select("i", pii.running(F.col("c"), lambda s, x: s + x).alias("s"), pii.running(F.col("c"), lambda m, x: F.greatest(m, x)).alias("m"))
    for r in got.collect():
        a = rows[r.i]
        assert (r.s or []) == [sum(a[:k]) for k in range(len(a))]
        assert (r.m or []) == [max(a[:k], default=0) for k in range(len(a))]


def test_mixing(spark, root):
    got = result(spark, "op9_mixing", root)
    docs = table(spark, root, "documents")
    assert len(got) == len(docs)
    source = {}
    sizes = collections.Counter()
    for d in docs:
        n = len(plain.WORD.findall(d["text"] or ""))
        sizes[d["source"]] += n
        source.setdefault(d["doc_id"], d["source"])
    goal = plain.targets(sizes)
    rows = [r for r in got if collections.Counter(d["doc_id"] for d in docs)[r["doc_id"]] == 1]
    taken = collections.Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - goal[s]) <= 1e-9 * max(goal[s], 1)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for r in got:
        assert r["taken"] <= 2 * r["size"]
    again = result(spark, "op9_mixing", root)
    same_rows([(r["doc_id"], r["taken"]) for r in got], [(r["doc_id"], r["taken"]) for r in again])
    if root == SMALL:
        longest = collections.Counter()
        for r in rows:
            taken[source[r["doc_id"]]] += r["taken"]
            longest[source[r["doc_id"]]] = max(longest[source[r["doc_id"]]], r["size"])
        for s in sizes:
            assert abs(taken[s] - goal[s]) <= longest[s] / 2 + 1e-6


def test_mixing_budgets_are_nested(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix(docs, budgets=(0.2, 0.5, 0.9)).collect()
    taken = collections.defaultdict(set)
    for r in rows:
        if r.copies:
            taken[r.budget].add(r.doc_id)
    one = {r.doc_id for r in rows if r.budget == 0.5 and r.target <= r.source_size}
    assert len(taken) == 3 and (taken[0.2] & one) <= taken[0.5]


def test_mix_repeats_rows(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    copies = collections.Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    out = mixing.repeat(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == +copies


def test_suffix_dedup(spark, edge_dir):
    docs = [d for d in table(spark, edge_dir, "documents") if len(d["text"] or "") < 10_000]
    rng = random.Random(9)
    # The long document is too long for the plain version; a shorter stand-in keeps its place.
    extra = "".join(rng.choice("abc ") for _ in range(5000))
    rows = [(d["doc_id"], d["text"]) for d in docs] + [(30, extra), (31, extra[1000:1400]), (32, extra[2000:2399]), (33, "é" + extra[3000:3600])]
    got = suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()
    expected = plain.without_repeats([t for _, t in rows])
    same_rows([tuple(r) for r in got], [(i, *x) for (i, _), x in zip(rows, expected)])


def test_suffix_dedup_groups_too_large_for_a_task(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    rng = random.Random(10)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(600))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(300)) + passage + "".join(rng.choice("xyz ") for _ in range(300)))
            for i in range(12)]
    got = suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()
    same_rows([tuple(r) for r in got], [(i, *x) for (i, _), x in zip(rows, plain.without_repeats([t for _, t in rows]))])


def test_suffix_dedup_of_a_row_repeated_many_times(spark):
    """A row 3,000 times, of which others hold parts: each repeat loses all, and no join meets repeats with repeats."""
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    rows = [(1, text)] * 3000 + [(2, "x" * 50 + text[100:700] + "y" * 50), (3, text[600:1100] + "z" * 10), (4, text[:399])]
    got = suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), with_text=False).collect()
    found = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in got)
    assert found == {(1, 1500, 1500, 1): 3000, (2, 700, 600, 1): 1, (3, 510, 500, 1): 1, (4, 399, 0, 0): 1}


def test_common_prefixes_equal_direct_ones():
    rng = np.random.default_rng(8)
    for alphabet in (2, 3, 30):
        text = np.r_[rng.integers(0, alphabet, 300), 1000]
        order, bwt = suffix_dedup.transform(text, 8)
        got = suffix_dedup.common_prefixes(bwt, 8)
        for r in range(1, len(text)):
            a, b, n = order[r - 1], order[r], 0
            while n < 8 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert got[r] == n


@pytest.mark.parametrize("name", ["op1_token_store", "op2_quality_rules", "op3_hyperminhash", "op4_multi_index", "op5_byte_bpe",
                                  "op6_importance", "op8_pii", "op9_mixing", "op10_suffix_dedup", "pipeline"])
def test_empty_tables(spark, empty_dir, name):
    assert result(spark, name, empty_dir) == []
