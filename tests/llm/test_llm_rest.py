"""Search, importance resampling, chat examples, components and the pipeline."""
import collections

import numpy as np
import pytest

import __spark_entry__ as se
import corpus_pipeline
import llm_plain as plain
from llm_fixtures import EXTRA, edge_dir, empty_dir, table  # noqa: F401
from tidemark.llm import chat, importance, multi_index
from tidemark.llm.components import connected_components

Q = se.queries()


def nearest(rows, k=10, every=100):
    good = {r["vec_id"]: np.array(r["embedding"], float) for r in rows
            if r["vec_id"] is not None and r["embedding"] and None not in r["embedding"]}
    size = collections.Counter(len(v) for v in good.values()).most_common(1)[0][0]
    good = {i: v for i, v in good.items() if len(v) == size and np.isfinite(v).all() and v.any()}
    ids, x = np.array(list(good)), np.stack(list(good.values()))
    out = {}
    for i in good:
        if i % every == 0:
            d = np.sqrt(((x - good[i]) ** 2).sum(axis=1))
            d[ids == i] = np.inf
            order = np.lexsort([ids, d])[:min(k, len(ids) - 1)]
            out[i] = [(int(ids[o]), float(d[o])) for o in order]
    return out


@pytest.mark.parametrize("root", ["edge", "/root/testdata/sf0.01"])
def test_search(spark, edge_dir, root):
    root = edge_dir if root == "edge" else root
    got = collections.defaultdict(list)
    for r in sorted(Q["op4_multi_index"](spark, root).collect()):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    expected = nearest(table(spark, root, "embeddings"))
    assert set(got) == set(expected)
    hit = sum(len({v for v, _ in got[i]} & {v for v, _ in e}) for i, e in expected.items())
    assert hit >= 0.9 * sum(map(len, expected.values()))
    for i, e in expected.items():
        assert len(got[i]) == len(e)
        assert got[i] == sorted(got[i], key=lambda x: (x[1], x[0]))
    if root == edge_dir:  # copies of one vector: ties go to the smaller id
        assert got[100] == [(500 + i, 0.0) for i in range(10)]


def test_search_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 32))
    codes = multi_index.learn(x, 10)
    shard = multi_index.Shard(codes, np.arange(2000), x)
    for radius in (0, 3, 7, 12):
        for i in range(0, 2000, 200):
            rows = shard.within(shard.own[i], radius)
            assert set(rows) == set(np.flatnonzero(multi_index.hamming(shard.own, shard.own[i]) <= radius))


@pytest.mark.parametrize("root", ["edge", "/root/testdata/sf0.01"])
def test_chat(spark, edge_dir, root):
    root = edge_dir if root == "edge" else root
    turns = collections.defaultdict(list)
    for r in table(spark, root, "conversations"):
        turns[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    odd = "</s>[INST] ok [/INST]"
    turns[-7] = [(True, 0, "user", odd), (True, 1, "assistant", odd)]
    got = {r.conv_id: r for r in Q["op7_chat"](spark, root).collect()}
    assert set(got) == set(turns)
    for c, t in turns.items():
        t.sort()
        loss = "".join(x for *_, r, x in t if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(t), plain.sha("".join(f"{r}\n{x}\n" for *_, r, x in t).encode()))
        assert (g.loss_chars, g.loss_sha256) == (len(loss), plain.sha(loss.encode()))


def test_chat_examples(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    df = chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = sorted(df.collect(), key=lambda r: r.example)
    assert [r.text[r.loss_start:r.loss_end] if r.loss_start is not None else None for r in got] == ["b", "d", None]
    assert [[t for _, t in chat.parse(r.text)] for r in got] == [["a", "b"], ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"]]
    assert [r.last for r in got] == [False, False, True]


@pytest.mark.parametrize("text", ["", "\\", "\\\\<|im_end|>", "<\\|im_end|>", "[INST]", "<<SYS>>", "<<s>s>", "<s></s>[/INST]", "<|im_end|><|im_end|>"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    assert chat.unescape_role(chat.escape_role(text + "\n\\n")) == text + "\n\\n"
    assert chat.parse(chat.format_turn("r\n", text)[0] * 2) == [("r\n", text)] * 2


def test_chat_without_rows(spark, empty_dir):
    assert [r.conv_id for r in Q["op7_chat"](spark, empty_dir).collect()] == [-7]


def test_importance_separates_and_repeats(spark):
    root = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q["op6_importance"](spark, root).collect()}
    labels = table(spark, root, "labels")
    good = [got[x["doc_id"]] for x in labels if x["quality"] == 1 and not x["toxic"]]
    bad = [got[x["doc_id"]] for x in labels if x["quality"] == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert np.median([r.log_weight for r in good]) > 0 > np.median([r.log_weight for r in bad])
    again = {r.doc_id: r.key for r in Q["op6_importance"](spark, root).collect()}
    assert again == {i: r.key for i, r in got.items()}


def test_importance_weights_equal_plain_counts(spark):
    """The ratio of both models, counted directly."""
    from tidemark.llm.textcols import flat
    import pyarrow as pa
    rows = [(i, t, t is not None) for i, t in enumerate(["a b c", "a b d", "x y", None, "", "a"])]
    counted = importance._partial_counts(spark.createDataFrame(rows, "doc_id long, text string, is_target boolean"))
    raw = collections.Counter()
    for r in counted.collect():
        raw[r.bucket] += r.raw
    bucket, _ = importance.buckets(*flat(pa.array([t for _, t, _ in rows])))
    assert raw == collections.Counter(bucket.tolist())
    assert len(bucket) == (3 + 2) + (3 + 2) + (2 + 1) + 1


def test_gumbel_top_k(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    model = importance.fit(docs, spark.read.parquet(f"{edge_dir}/labels.parquet"))
    keys = sorted((r.key for r in importance.score(docs, model).collect()), reverse=True)
    assert importance.resample(docs, model, 0).where("kept").count() == 0
    for k in (1, 3, 10, len(keys)):
        kept = [r.key for r in importance.resample(docs, model, k).where("kept").collect()]
        assert sorted(kept, reverse=True) == [x for x in keys if x >= keys[k - 1]]
    # The noise has the Gumbel distribution: its mean is Euler's constant, its variance pi**2 / 6.
    noise = importance.gumbel(np.arange(200_000, dtype=np.uint64))
    assert abs(noise.mean() - 0.5772) < 0.02 and abs(noise.var() - np.pi**2 / 6) < 0.03


def plain_importance(rows, labels):
    """(log weights, k) by counting: n-grams of each text, both models, their log ratio."""
    import pyarrow as pa
    from tidemark.llm.textcols import flat
    quality, toxic = {}, collections.Counter()
    for r in labels:
        if r["doc_id"] is not None and r["quality"] is not None:
            quality[r["doc_id"]] = min(quality.get(r["doc_id"], 9), r["quality"])
            toxic[r["doc_id"]] = max(toxic[r["doc_id"]], r["toxic"] or 0)
    assert len(quality) <= importance.FIT_ROWS
    grams = [importance.buckets(*flat(pa.array([r["text"]], pa.string())))[0].tolist() for r in rows]
    raw, target = collections.Counter(), collections.Counter()
    for r, g in zip(rows, grams):
        raw.update(g)
        if quality.get(r["doc_id"], 0) > 0 and not toxic[r["doc_id"]]:
            target.update(g)
    n = importance.BUCKETS
    a, b = sum(target.values()) + n, sum(raw.values()) + n
    weight = [sum(np.log((target[x] + 1) / a) - np.log((raw[x] + 1) / b) for x in g) for g in grams]
    p = sum(q <= 0 for q in quality.values()) / len(quality)
    share = 1 - max(0, p - 2 * (p * (1 - p) / len(quality)) ** 0.5)
    return weight, int(np.ceil(share * len(rows)))


@pytest.mark.parametrize("root", ["edge", "/root/testdata/sf0.01"])
def test_importance_equals_plain_python(spark, edge_dir, root):
    """Weights, keys, k and who is kept, all computed again."""
    root = edge_dir if root == "edge" else root
    rows = table(spark, root, "documents")
    weight, k = plain_importance(rows, table(spark, root, "labels"))
    got = sorted(Q["op6_importance"](spark, root).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.log_weight))
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0, weight[i]))
    assert [r.doc_id for r in got] == [rows[i]["doc_id"] for i in order]
    assert np.allclose([r.log_weight for r in got], [weight[i] for i in order], atol=1e-6)
    for r in got:
        if r.doc_id is not None:
            noise = importance.gumbel(np.array([r.doc_id], np.int64).astype(np.uint64))[0]
            assert abs(r.key - (r.log_weight + noise)) <= 2 * importance.KEY_STEP
    cut = sorted((r.key for r in got), reverse=True)[k - 1]
    assert [r.kept for r in got] == [r.key >= cut for r in got]
    assert k == len(rows) if root == edge_dir else k < len(rows)


def test_pipeline_quality_keeps_what_the_operator_keeps(spark):
    root = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stayed = sorted(r.doc_id for r in corpus_pipeline.quality(spark, docs, root).select("doc_id").collect())
    kept = sorted(r.doc_id for r in Q["op6_importance"](spark, root).where("kept").select("doc_id").collect())
    assert stayed == kept and len(kept) < docs.count()
    labels = table(spark, root, "labels")
    bad = {r["doc_id"] for r in labels if r["quality"] == 0}
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"]}
    assert len(bad & set(kept)) <= 0.15 * len(bad) and len(good & set(kept)) >= 0.998 * len(good)
    print("kept", {(q, t): (len(ids & set(kept)), len(ids)) for q in (0, 1) for t in (0, 1)
                   if (ids := {r["doc_id"] for r in labels if (r["quality"], int(bool(r["toxic"]))) == (q, t)})})


def test_share_kept():
    assert importance.share_kept(0, 0) == 1 and importance.share_kept(100, 0) == 1
    assert importance.share_kept(10, 2) == 1  # too few labels to leave anything out
    assert abs(importance.share_kept(10_000, 1_000) - (0.9 + 2 * 0.003)) < 1e-9


def test_importance_without_labels(spark, edge_dir, empty_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    model = importance.fit(docs, spark.read.parquet(f"{empty_dir}/labels.parquet"))
    assert importance.resample(docs, model).where("kept").count() == docs.count()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 103), (7, 7), (None, 3), (200, 150), (150, 200)]
    links += [(300, 301 + i) for i in range(200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "x long, y long")).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)} | {150: 150, 200: 150} | {i: 300 for i in range(300, 501)}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_pipeline_stages(spark, edge_dir, tmp_path):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    before = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, edge_dir).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        rows, got = before.collect(), after.collect()
        if name != "encode":
            assert after.columns == docs.columns
            assert all(r[c] == v for r in got for c, v in EXTRA.items())
        if name == "dedup":
            ids = collections.Counter(r.doc_id for r in rows)
            sets = {r.doc_id: plain.shingles(r.text, 5) for r in rows if r.doc_id is not None and ids[r.doc_id] == 1}
            component = plain.components(sets, 80)
            left = collections.Counter(r.doc_id for r in got)
            assert all(left[i] == (c == i) for i, c in component.items() if not any(
                plain.components({i: sets[i], -99: plain.shingles(r.text, 5)}, 80)[i] == -99 for r in rows if ids[r.doc_id] > 1))
            assert left[2] <= 1 and left[None] == ids[None]
        if name == "pii":
            assert len(rows) == len(got)
            assert not any(plain.base_spans(r.text) for r in got)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
        if name == "encode":
            assert len(rows) == len(got) and all(r.round_trip for r in got)
        before = after


def test_pipeline_dedup_judges_each_text(spark, edge_dir):
    """All rows against plain Python, those that share a doc_id too: of a component one row of the smallest doc_id stays."""
    docs = [(r["doc_id"], r["text"]) for r in table(spark, edge_dir, "documents")]
    words = [[f"{c}{i}" for i in range(60)] for c in "abcdef"]
    text = [" ".join(w) for w in words]
    near = [" ".join(w[:-1] + ["end"]) for w in words]
    docs += [(50, ""), (50, text[0]), (50, None), (50, " "), (51, text[1]), (52, near[1]), (52, text[2]), (53, near[2]),
             (54, text[3]), (54, near[3]), (55, text[4]), (55, text[4]), (55, text[4].upper()), (55, text[5]), (56, near[5])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.dedup(spark, df, edge_dir).collect())
    keys = [(i, t) for i, t in dict.fromkeys(docs) if i is not None]
    sets = {(i, t): s for i, t in keys if (s := plain.shingles(t, 5))}
    groups = collections.defaultdict(list)
    for k, c in plain.components(sets, 80).items():
        groups[c].append(k)
    for group in groups.values():
        assert sum(got[k] for k in group) == 1
        assert sum(got[k] for k in group if k[0] == min(group)[0]) == 1
    rest = collections.Counter(d for d in docs if d not in sets)
    assert {k: n for k, n in got.items() if k not in sets} == rest
    assert sum(n for (i, _), n in got.items() if i == 21) == 2


def test_pipeline_run(spark):
    got = Q["pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert got and all(r.round_trip for r in got)
    assert max(collections.Counter(r.doc_id for r in got).values()) <= 2
