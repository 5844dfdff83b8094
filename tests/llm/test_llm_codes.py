"""Vector codes, url rules and fill-in-middle against plain Python."""
import collections
import hashlib
import math
import random

import numpy as np
import pytest

import __spark_entry__ as se
from llm_fixtures import edge_dir, empty_dir, table  # noqa: F401
from llm_plain import sha
from tidemark.llm import fill_middle, url_rules, vector_codes

Q = se.queries()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(params=["edge", "small"])
def root(request, edge_dir):
    return edge_dir if request.param == "edge" else SMALL


def same(got, columns, expected):
    rows = collections.Counter(tuple(r[c] for c in columns) for r in got)
    assert rows == collections.Counter(expected)


# ----------------------------------------------------------------- vector codes
def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Full rescans with Python integers."""
    good = [r for r in rows if r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    sizes = collections.Counter(len(r["embedding"]) for r in good)
    size = max(sizes, key=lambda s: (sizes[s], s))
    good = sorted((r for r in good if len(r["embedding"]) == size),
                  key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["embedding"]))
    width = -(-size // parts)
    x = [[math.floor(256 * v) for v in r["embedding"]] + [0] * (parts * width - size) for r in good]
    cut = [[tuple(v[j * width:(j + 1) * width]) for j in range(parts)] for v in x]
    books = [[v[j] for v in cut[:entries]] for j in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(p, e)), k) for k, e in enumerate(books[j])) for j, p in enumerate(v)] for v in cut]
    for _ in range(rounds):
        found = assign()
        for j in range(parts):
            mine = collections.defaultdict(list)
            for v, f in zip(cut, found):
                mine[f[j][1]].append(v[j])
            books[j] = [tuple(sum(c) // len(mine[k]) for c in zip(*mine[k])) if k in mine else e for k, e in enumerate(books[j])]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    label = collections.Counter()
    for r, e in zip(good, error):
        label[r["label"]] += e
    book = sha(",".join(str(c) for b in books for e in b for c in e).encode())
    return [(r["vec_id"], "".join(f"{k:02x}" for _, k in f), e, label[r["label"]], book) for r, f, e in zip(good, found, error)]


CODES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def test_vector_codes(spark, root):
    got = Q["op11_vector_codes"](spark, root).collect()
    same(got, CODES, plain_codes(table(spark, root, "embeddings")))


def test_vector_codes_with_large_components_and_null_labels(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-200_000, 200_000)) * rng.random() for _ in range(32)], rng.choice([None, "a", "b"])) for i in range(150)]
    rows += [(None, rows[0][1], None), (7, rows[8][1], "a")]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = Q["op11_vector_codes"](spark, str(tmp_path)).collect()
    same(got, CODES, plain_codes([dict(zip(("vec_id", "embedding", "label"), r)) for r in rows]))


def test_fewer_vectors_than_entries_and_none(spark, tmp_path, empty_dir):
    rows = [(i, [i / 10, -i / 7] * 8, 0) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    coded, books = vector_codes.compress(df)
    assert books.shape == (16, 5, 1) and coded.where("error <> 0").count() == 0
    assert Q["op11_vector_codes"](spark, empty_dir).collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(df, entries=300)


@pytest.mark.parametrize("seed", range(8))
def test_active_entries_give_what_a_full_scan_gives(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-4, 5, (300, 3))  # many equal distances
    books = rng.integers(-4, 5, (20, 3))
    code, distance = vector_codes.scan(x, books)
    for share in (0, 0.1, 0.5, 1):
        moved = rng.random(20) < share
        new = np.where(moved[:, None], books + rng.integers(-2, 3, (20, 3)), books)
        moved = (new != books).any(axis=1)
        a, b, compared = vector_codes.rescan(x, new, moved, code, distance)
        expected = [min((int(((v - e) ** 2).sum()), k) for k, e in enumerate(new)) for v in x]
        assert list(zip(b.tolist(), a.tolist())) == expected
        assert compared == moved[code].sum() * 20 + (~moved[code]).sum() * moved.sum()
        books, code, distance = new, a, b


def test_distances_are_exact_beyond_doubles():
    x = np.array([[2**26, -2**26 + 1]] * 2)
    e = np.array([[-2**26, 2**26], [2**26 - 1, -2**26]])
    assert vector_codes.distances(x, e).tolist() == [[(2**27)**2 + (2**27 - 1)**2, 2]] * 2


# ----------------------------------------------------------------- url rules
def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, 0, None, default)
    return host, path, best[3], best[4]


URLS = ("page_id", "host", "path", "rule", "verdict")
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_url_rules(spark, root):
    pages = table(spark, root, "pages")
    same(Q["op12_url_rules"](spark, root).collect(), URLS, [(r["page_id"], *plain_verdict(r["url"], RULES)) for r in pages])


def test_url_rules_of_many_shapes_and_in_several_tries(spark, tmp_path):
    rng = random.Random(9)
    hosts = ["", "a", "b.a", "c.b.a", "d", "a.d", "xa", ".a"]
    paths = ["", "/", "/p", "/p/", "/pq", "/p/q", "/p/q/", "//", "/é"]
    rules = [url_rules.Rule(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    plain = [(r.host, r.path, r.verdict) for r in rules]
    urls = [f"s://{h}{p}{t}" for h in ["a", "b.a", "z.c.b.a", "A.D", "xa", "", "e", "..a"] for p in paths + ["/p/q/r/s", "/pqr/"] for t in ("", "?x/", "#")]
    expected = [(i, *plain_verdict(u, plain, "block")) for i, u in enumerate(urls)]
    root = url_rules.build(rules)
    for u, e in zip(urls, expected):
        rule = url_rules.longest(root, *url_rules.split_url(u))
        assert (rule and rule.host + rule.path) == e[3]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(2)
    for limit in (url_rules.TRIE_BYTES, 150):
        same(url_rules.judge(df, rules, "block", limit).collect(), URLS, expected)
    assert len(url_rules.shares(rules, 150)) > 2
    assert {r.verdict for r in url_rules.judge(df, []).collect()} == {"allow"}


def test_url_rules_of_no_pages(spark, empty_dir):
    assert Q["op12_url_rules"](spark, empty_dir).collect() == []
    with pytest.raises(ValueError):
        url_rules.parse_rule("a/b", "perhaps")


# ----------------------------------------------------------------- fill-in-middle
def plain_form(doc_id, text, seed="1"):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    form = "spm" if h4 % 100 < 20 else "psm"
    p, m, s = t[:a], t[a:b], t[b:]
    return n, form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


FIM = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def test_fill_middle(spark, root):
    expected = []
    for d in table(spark, root, "documents"):
        *head, out = plain_form(d["doc_id"], d["text"])
        expected.append((d["doc_id"], *head, sha(out.encode()), sha((d["text"] or "").encode())))
    same(Q["op13_fill_middle"](spark, root).collect(), FIM, expected)


def test_fill_middle_texts_and_back(spark):
    rng = random.Random(1)
    parts = ["<", "P>", "<P", "<S", "S>", "M", ">", "é", "😀", "日本", " ", "a", "\n", "<<", "<P>"]
    docs = [(i, "".join(rng.choice(parts[:-1] if i % 9 else parts) for _ in range(rng.randint(0, 12)))) for i in range(600)] + [(None, "abc"), (601, None)]
    formed = fill_middle.transform(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    rows = formed.collect()
    same(rows, ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"), [(i, *plain_form(i, t)) for i, t in docs])
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    back = fill_middle.restore(formed.withColumn("text", formed.output)).collect()
    same(back, ("doc_id", "text"), [(i, t or "") for i, t in docs])
    assert all(r.restored_sha256 == sha(r.text.encode()) for r in back)
    other = fill_middle.transform(spark.createDataFrame(docs, "doc_id long, text string"), sentinels=("\x01pre", "\x02suf", "\x03mid"), fim_percent=100)
    same(fill_middle.restore(other, sentinels=("\x01pre", "\x02suf", "\x03mid")).collect(), ("doc_id", "text"), [(i, t or "") for i, t in docs])


def test_damaged_outputs_and_unfit_sentinels_are_refused():
    marks = fill_middle.check_sentinels(fill_middle.SENTINELS)
    for text in ("<P>a<S>b", "a<P>b<S>c<M>d", "<S>a<P>b<M>c", "<P>a<S>b<M>c<M>"):
        raw = np.frombuffer(text.encode(), np.uint8)
        with pytest.raises(ValueError):
            fill_middle.restore_batch(raw, np.array([0, len(raw)]), np.array(["psm"], object), marks)
    for bad in (("<P>", "<P>", "<M>"), ("<<", "a", "b"), ("ab", "bc", "d"), ("", "a", "b"), ("a", "ax", "b")):
        with pytest.raises(ValueError):
            fill_middle.check_sentinels(bad)


def test_fill_middle_of_no_documents(spark, empty_dir):
    assert Q["op13_fill_middle"](spark, empty_dir).collect() == []
