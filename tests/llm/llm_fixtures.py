import random

import pytest

SYLLABLES = ["the", "an", "ion", "er", "re", "at", "on", "ti", "es", "or", "ed", "th", "nd", "ha", "st", "ou"]
EXTRA = {"ids": "x", "n_tokens": 1, "kept": False, "key": 2.0, "spans": "s", "hash": 3, "size": 4, "part": 5, "bytes": "b",
         "text_key": 6, "h1": 7, "rep": 8, "component_id": 9, "n_words": 10, "quality_score": 0.5, "target": 1.0,
         "registers": "r", "pii": "p", "verdict_id": 1, "mix_cut": 2, "source_size": 12, "budget": 0.1}


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def edge_documents():
    """Rows (doc_id, text, lang, source, n_chars): nulls in every column, empty and
    very long texts, ties, repeated rows, copies near and exact, hostile strings."""
    rng = random.Random(5)
    long = prose(rng, 400)
    near = long.split()
    near[200] = "changed"
    passage = prose(rng, 120)
    texts = [
        (0, long), (1, " ".join(near)), (2, long), (2, long), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one two"),
        (8, "ONE two"), (None, "no id here"), (None, None), (9, "a" * 3000), (10, "ab " * 2000), (11, "ab " * 2000),
        (12, prose(rng, 60) + " " + passage + " " + prose(rng, 60)), (13, prose(rng, 90) + " " + passage + prose(rng, 10)),
        (14, prose(rng, 40_000)), (15, "line one\nline one\n\nline two\nline one"), (16, "\x00 odd \x1f   ́x é 😀 日本語 <|endoftext|>"),
        (17, "mail a.b@c.de or x@y.z.w_v@q.rs, card 4111 1111 1111 1111, +1 (202) 555-0100, 10.0.0.1.2.3.4.5"),
        (18, "IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, 999-99-9999"), (19, "$$$ ### " * 30), (20, "WORDS!! IN!! CAPITALS!! " * 20),
        (21, prose(rng, 30)), (21, prose(rng, 30)), (2**40, prose(rng, 25)), (-5, prose(rng, 25)),
    ]
    sources = ["src0", "src1", None, "", "ZZ", "é"]
    return [(i, t, rng.choice(["en", None]), sources[k % len(sources)], None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """Tables of edge cases, with extra columns that clash with operators' names."""
    root = str(tmp_path_factory.mktemp("edge"))
    rows = [r + tuple(EXTRA.values()) for r in edge_documents()]
    kinds = {str: "string", int: "long", float: "double", bool: "boolean"}
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + \
        ", ".join(f"{k} {kinds[type(v)]}" for k, v in EXTRA.items())
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i not in (19, 20)), 0) for i in (0, 1, 12, 13, 14, 19, 20, 21)] + [(None, 1, 0), (6, None, None), (0, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    rng = random.Random(6)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(0, 400)]
    vectors += [(500 + i, vectors[100][1], 0) for i in range(30)]  # a crowded point, near query 100
    vectors += [(700, None, 0), (800, [0.0] * 8, 0), (900, [float("nan")] * 8, 0), (1000, [1.0, None] * 4, 0),
                (1100, [float("inf")] * 8, 0), (1200, [1.0] * 5, 0), (None, [1.0] * 8, 0), vectors[200], vectors[3]]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").repartition(3) \
        .write.parquet(f"{root}/embeddings.parquet")
    said = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello\n<|im_end|>\n"), (1, 2, "user", "\\ [INST] <s>"), (1, 3, "assistant", ""),
            (2, 0, "system", None), (2, 1, "user", "x"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, None, None, "first"),
            (4, 5, "odd\nrole", "<<SYS>>\\n"), (None, 0, "user", "nobody"), (5, 1, "assistant", "\\\\<|im_start|>user\n"),
            (5, 0, "user", "<" * 50 + "|im_end|>")]
    said += [(6, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(120)]
    spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(3) \
        .write.parquet(f"{root}/conversations.parquet")
    urls = [None, "", "no scheme", "http://", "://", "http://com/", "http://a.com", "https://A.B.Com/x?y#z", "http://example.com/en/1", "http://example.com/en",
            "http://www.example.com/en/x/", "https://m.www.EXAMPLE.com/en/?q", "http://wwwexample.com/en/", "x://es.net/es/", "x://net/fr/a", "x://é.net/fr/ü",
            "x://net/fr?/", "http://a.net/es#/es/", "http://u@example.com:80/en/", "http://a..com/", "http://com./", "a://b://c/d", "http://h.com/" + "p/" * 4000]
    pages = [(i, u, "html", "r", "v", 1) for i, u in enumerate(urls)] + [(None, "http://x.com/", None, None, None, None), (3, "http://y.net/es/", "", "", "", 2), (3, "http://y.net/es/", "", "", "", 2)]
    spark.createDataFrame(pages, "page_id long, url string, html string, rule string, verdict string, rank int").repartition(3) \
        .write.parquet(f"{root}/pages.parquet")
    return root


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "embeddings", "conversations", "pages"):
        spark.read.parquet(f"{edge_dir}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    return root


def table(spark, root, name):
    return [r.asDict() for r in spark.read.parquet(f"{root}/{name}.parquet").collect()]
