import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60))
def test_pack_keeps_the_capacity_and_pairs_large_pieces(pieces):
    place = packing.pack(pieces, 30)
    bins = {}
    for size, c in zip(pieces, place, strict=True):
        bins.setdefault(c, []).append(size)
    assert all(sum(b) <= 30 and sum(3 * s > 30 for s in b) <= 2 for b in bins.values())
    assert sorted(bins) == list(range(len(bins)))


def test_every_document_whole_and_well_filled(spark):
    rng = random.Random(4)
    data = [(i, rng.choice([0, 3, rng.randint(1, 900), rng.randint(200, 2500)]), "x") for i in range(4000)] + [(9000, None, "x"), (9001, 1000, "x"), (9002, 2000, "x")]
    rows = packing.containers(spark.createDataFrame(data, "doc_id bigint, n_tokens bigint, container_id string"), len(data), 1000, 1500).collect()
    per_doc, per_bin = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
        per_bin[r.container_id] = per_bin.get(r.container_id, 0) + r.n_tokens
    assert set(per_doc) == {d for d, _, _ in data}
    for d, n, _ in data:
        n, parts = n or 0, sorted(per_doc[d])
        assert sum(x for _, x in parts) == n and [f for f, _ in parts] == [i * 1000 for i in range(len(parts))]
        assert len(parts) == max(1, -(-n // 1000))
    assert max(per_bin.values()) <= 1000 and sum(per_bin.values()) / (1000 * len(per_bin)) > 0.97
    assert packing.containers(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), 0).count() == 0


@pytest.mark.skipif(not os.path.exists(packing.TOKENIZER), reason="no vocabulary file")
def test_counts_are_those_of_the_whole_text(spark):
    enc = packing.encoder(packing.TOKENIZER)
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "Word", " ", "  ", "\n", "\n\n", "\t", "é", "12", "'s", ".", "{{x}}", " \n", "\r\n", "日本", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["", "\n", "\n\n a", "x" * 50_000, "line\n" * 5000]
    assert [packing.token_count(t) for t in texts] == [len(enc.encode_ordinary(t)) for t in texts]
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id bigint, text string")
    assert {r.doc_id: r.n_tokens for r in packing.sizes(df).collect()} == {1: 2, 2: 0, 3: 0}


def test_the_judgement_sees_every_fault(spark):
    measured = spark.createDataFrame([(1, 5), (2, 25), (3, 4), (4, 9), (5, None)], "doc_id bigint, n_tokens bigint")
    rows = [(0, 1, 0, 0, 3), (1, 1, 1, 3, 2), (2, 2, 0, 0, 10), (3, 2, 1, 10, 10), (3, 4, 0, 0, 8)]
    packed = spark.createDataFrame(rows, "container_id bigint, doc_id bigint, piece_no bigint, first_token bigint, n_tokens bigint")
    r = packing.fill_report(packed, measured, 10).first()
    assert (r.n_docs, r.n_missing, r.n_overfull, r.n_split, r.n_torn, r.n_containers, r.n_least) == (5, 2, 1, 1, 2, 4, 5)
    sound = packing.fill_report(packing.containers(measured, 5, 10), measured, 10).first()
    assert (sound.n_missing, sound.n_overfull, sound.n_split, sound.n_torn) == (0, 0, 0, 0) and sound.n_containers == sound.n_least == 5
    assert packing.fill_report(packed.limit(0), measured.limit(0)).first().fill == 1.0
