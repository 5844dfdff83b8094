"""Texts are dealt out and hashed once, however many comparisons follow."""
import random

import llm_plain as plain
from tidemark.llm import hyperminhash


def test_sets_are_made_once_for_both_comparisons(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    monkeypatch.setattr(hyperminhash, "PIVOTS", 1)
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    rows, words = [], list(base)
    for i in range(80):
        if i % 10 == 0:
            words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(150)] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    written, place = [], hyperminhash.scratch_path
    monkeypatch.setattr(hyperminhash, "scratch_path", lambda s, name: written.append(name) or place(s, name))
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == plain.components({i: plain.shingles(t, 3) for i, t in rows}, 85)
    assert written.count("sets") == 1 and "links-in-blocks" in written and "links-across-blocks" in written
