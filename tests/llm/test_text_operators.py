"""Operators on whole texts against brute force, and their edge cases."""

import base64
import hashlib
import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from foldergrid.llm import bpe, components, decontaminate, maxent, quality, registry, simhash, toxicity  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fingerprint string, word string, root int"


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 0.5, "x", "y", 7) for i, t in rows], DOCS)


LONG = "the rain in spain stays mainly on the plain " * 20_000
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (4, "one"), (None, "one two three"), (5, LONG), (6, "a b c d e"), (6, "A  B c D e")]


@pytest.fixture(scope="module")
def tables(spark):
    at = "/root/testdata/sf0.01"
    return {n: spark.read.parquet(f"{at}/{n}.parquet") for n in ("documents", "labels", "benchmark")}


# ------------------------------------------------------------- byte-level BPE
@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(Path(VOCABULARY).read_bytes(), bpe.codepoint_ranges())


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abstmdlrev''  \n\t.!?12é中\x1c\x85 ٣𝄞"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=6))
def test_bpe_equals_tiktoken(codec, reference, texts):
    encoded = codec.encode(texts) if texts else []
    assert [ids(e) for e in encoded] == [reference.encode_ordinary(t) for t in texts]
    assert [codec.decode(e) for e in encoded] == [t.encode() for t in texts]


def test_bpe_long_runs_and_slices(codec, reference):
    text = "x" * 5000 + "!?" * 3000 + " " * 2000 + "don't we'll 's" + "é" * 999
    [encoded] = codec.encode([text])
    assert ids(encoded) == reference.encode_ordinary(text)
    offsets, raw = codec.offsets(encoded), text.encode()
    for start, stop in ((0, 0), (0, 1), (4999, 5003), (10_990, 13_020), (len(raw) - 1, len(raw)), (5, len(raw))):
        assert codec.decode_slice(encoded, offsets, start, stop) == raw[start:stop]


def test_bpe_operator(spark, reference):
    rows = bpe.encode_and_decode(docs(spark, ODD).withColumn("ids", F.lit(1)), "text", VOCABULARY).collect()
    assert len(rows) == len(ODD) and {r["source"] for r in rows} == {"src0"}
    for r in rows:
        text = r["text"] or ""
        assert ids(r["ids"]) == reference.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
    digest = {r["doc_id"]: r for r in bpe.digests(docs(spark, ODD), VOCABULARY).collect()}
    assert digest[1]["n_tokens"] == 0 and digest[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    want = np.array(reference.encode_ordinary("one two three"), "<u4").tobytes()
    assert digest[None]["ids_sha256"] == hashlib.sha256(want).hexdigest()
    assert bpe.digests(docs(spark, []), VOCABULARY).count() == 0
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    cut = docs(spark, [(1, "hello there world")]).select(tokenizer.decode_slice(tokenizer.encode(F.col("text")), F.lit(3), F.lit(11)).alias("s"))
    assert bytes(cut.first()["s"]) == b"lo there"


def test_bpe_query_equals_tiktoken(spark, reference, sf_dir):
    got = {r["doc_id"]: r for r in registry.byte_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        own = np.array(reference.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        assert got[r["doc_id"]]["n_tokens"] == len(own) // 4 and got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(own).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


# ------------------------------------------------------------- quality
@pytest.fixture(scope="module")
def larger(spark):
    return {n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels")}


def test_quality_on_held_out_documents(larger):
    got = quality.classify(larger["documents"], larger["labels"]).join(larger["labels"], "doc_id").where("held_out").collect()
    assert len(got) > 400 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.995


def test_quality_edges(spark, tables):
    model = quality.train(tables["documents"], tables["labels"])
    rows = docs(spark, ODD).withColumn("own", quality.quality_score(model, F.col("text"))).collect()
    assert len(rows) == len(ODD) and all(0 <= r["own"] <= 1 for r in rows)
    assert len({r["own"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    none = tables["labels"].limit(0)
    assert {r["score"] for r in quality.classify(docs(spark, ODD), none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1, 0), (4, None, None), (6, 1, 0), (6, 0, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.classify(docs(spark, ODD), odd).count() == len(ODD)
    assert quality.classify(docs(spark, []), tables["labels"]).count() == 0
    assert quality.keep_good(docs(spark, ODD), none).columns == docs(spark, []).columns


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    values = rng.random((4000, len(quality.FEATURES)))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel(rounds=20).fit(values[:3000], labels[:3000])
    assert {model.pair_tables[0][0], model.pair_tables[0][1]} == {0, 1}
    assert np.mean((model.score(values[3000:]) > 0.5) == labels[3000:]) > 0.9
    # the sum of tables read entry by entry
    row = values[0]
    total = model.intercept + sum(t[np.searchsorted(c, x, side="right")] for c, t, x in zip(model.edges, model.tables, row))
    total += sum(t[np.searchsorted(model.coarse[a], row[a], side="right"), np.searchsorted(model.coarse[b], row[b], side="right")] for a, b, t in model.pair_tables)
    assert math.isclose(model.score(values[:1])[0], 1 / (1 + math.exp(-total)))


# ------------------------------------------------------------- toxicity
def brute_segments(scores, low=0):
    """The best run, then the same to its left and right."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > 1e-12 and (best is None or (total, a - b) > (best[2] + 1e-12, best[0] - best[1])):
                best = (a, b, total)
    if best is None:
        return []
    a, b, total = best
    return brute_segments(scores[:a], low) + [(a + low, b + low, total)] + brute_segments(scores[b:], low + b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=24))
def test_segments(scores):
    # distinct fractions keep the best run unique
    exact = [s + ((i + 1) * 0.618034) % 1 / 1000 for i, s in enumerate(scores)]
    got = toxicity.segments(np.array(exact))
    want = brute_segments(exact)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxicity_on_held_out_documents(larger):
    got = toxicity.classify(larger["documents"], larger["labels"]).join(larger["labels"], "doc_id").where("held_out").collect()
    assert len(got) > 400 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.98
    assert sum(r["predicted"] for r in got if r["toxic"] == 0) <= 2


def test_texts_without_a_segment_score_lowest(larger):
    model = toxicity.train(larger["documents"], larger["labels"])
    assert model.lexicon and model.slope > 0
    clean = [model.document(text)[0] for text in (None, "", "zzqq", "zzqq " * 30, "zzqq " * 5000)]
    word = next(w for w in model.lexicon if not w.endswith(b"*")).decode()
    assert clean[0] < 0.5 and clean[0] < model.document(word)[0] and clean[0] == clean[1] == clean[2] == clean[3] == clean[4]


def test_toxicity_passages_and_edges(spark, tables):
    model = toxicity.ToxicityModel({b"vile": 5.0, b"rotte*": 4.0}, -0.1, 2.0, 0.0, 0.0, 1.0)
    text = "Ä Some, good words here " * 8 + "VILE and rotten things. " + "good words " * 80 + "vile"
    score, passages = model.document(text)
    assert score > 0.5 and [text.lower().encode()[p["first_byte"] : p["end_byte"]] for p in passages] == [b"vile and rotten", b"vile"]
    plain, none = model.document("good words")
    assert plain < 0.5 and none == [] and model.document(None) == model.document("")
    rows = docs(spark, ODD).withColumn("t", toxicity.toxicity(model, F.col("text"))).collect()
    assert len(rows) == len(ODD) and all(r["t"]["passages"] == [] for r in rows)
    for labels in (tables["labels"].limit(0), tables["labels"].where("toxic = 0"), tables["labels"]):
        assert toxicity.classify(docs(spark, ODD), labels).count() == len(ODD)
    assert toxicity.classify(docs(spark, []), tables["labels"]).count() == 0
    assert toxicity.drop_toxic(docs(spark, ODD), tables["labels"].limit(0)).columns == docs(spark, []).columns


# ------------------------------------------------------------- SimHash
def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def crowd(rng, centres, copies, flips):
    out = [int(c) for c in centres]
    for c in centres:
        for _ in range(copies):
            out.append(int(c) ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, flips + 1))}))
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_planes_and_cells(radius):
    rng = np.random.default_rng(radius)
    prints = crowd(rng, rng.integers(0, 2**64, 80, dtype=np.uint64), 4, 9)
    query, place = simhash.within(prints[:70], simhash.planes_of(prints), radius)
    keep = place < len(prints)
    near = np.argwhere(np.bitwise_count(prints[:70, None] ^ prints[None, :]) <= radius)
    assert sorted(zip(query[keep], place[keep])) == [tuple(p) for p in near.tolist()]
    assert (simhash.cell_groups(prints, radius) == plain_components(prints, radius)).all()


def test_links_of_crowds_lose_none(spark):
    """Several thousand fingerprints about few centres: cells are cut into parts."""
    rng = np.random.default_rng(5)
    prints = crowd(rng, rng.integers(0, 2**64, 3, dtype=np.uint64), 1500, 5)
    prints = np.concatenate([prints, rng.integers(0, 2**64, 500, dtype=np.uint64)])
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint bigint")
    got = {r["fingerprint"]: r["root"] for r in simhash.classes(frame).collect()}
    label = plain_components(prints, 4)
    roots = {}
    for p, group in zip(prints.view(np.int64).tolist(), label.tolist()):
        assert roots.setdefault(group, got[p]) == got[p]
    assert len(set(roots.values())) == len(roots)


@pytest.mark.parametrize("cell_rows", [512, 1 / 64, 1 / 4096])
def test_keys_of_several_ranges_lose_no_link(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(8)
    prints = np.unique(np.array([*crowd(rng, rng.integers(0, 2**64, 30, dtype=np.uint64), 20, 4), *rng.integers(0, 2**64, 300, dtype=np.uint64)], np.uint64))
    chosen, leading, ranges = simhash.key_ranges(len(prints), 4)
    assert ranges == 4 + len(chosen[0]) and leading * ranges <= 64
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint bigint")
    got = {r["fingerprint"]: r["root"] for r in simhash.classes(frame).collect()}
    label, roots = plain_components(prints, 4), {}
    for p, group in zip(prints.view(np.int64).tolist(), label.tolist()):
        assert roots.setdefault(group, got[p]) == got[p]
    assert len(set(roots.values())) == len(roots) and len(roots) < len(prints)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(30):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_simhash_query_and_edges(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = np.array([plain_fingerprint(r["text"]) for r in rows], np.uint64)
    label = plain_components(prints, 4)
    smallest = {}
    for r, group in zip(rows, label.tolist()):
        smallest[group] = min(smallest.get(group, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], f"{int(p):016x}", smallest[g]) for r, p, g in zip(rows, prints, label.tolist())}
    assert {tuple(r) for r in registry.simhash_near_dedup(spark, sf_dir).collect()} == want

    got = simhash.near_duplicates(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    empty = [r for r in got if r["doc_id"] in (1, 2, 3)]
    assert {(r["fingerprint"], r["component_id"]) for r in empty} == {("0" * 16, 1)}
    assert next(r for r in got if r["doc_id"] is None)["component_id"] is None
    kept = simhash.keep_one(docs(spark, ODD))
    assert kept.columns == docs(spark, []).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, None], key=str)
    assert simhash.near_duplicates(docs(spark, [])).count() == simhash.keep_one(docs(spark, [])).count() == 0


# ------------------------------------------------------------- decontamination
def plain_scores(index, words):
    present = set(words)
    scores = Counter()
    for word, number in index.terms.items():
        if word in present:
            for item, value in zip(*index.postings[number]):
                scores[item] += value
    return scores


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.9])
def test_search_equals_all_scores(threshold):
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))), "") for i in range(150)]
    index = decontaminate.ItemIndex.build(items)
    for _ in range(60):
        words = [w.encode() for w in rng.choices(vocabulary, k=rng.randrange(0, 130))]
        if rng.random() < 0.5:
            words[5:5] = items[rng.randrange(150)][1].encode().split()
        terms = {index.terms[w] for w in words if w in index.terms}
        got = dict(index.search(terms, threshold)) if terms else {}
        want = {i: s for i, s in plain_scores(index, words).items() if s >= threshold - 1e-9}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i]) for i in got)
        # the bounds of the blocks never lose a passage that scores enough
        flat = np.array([index.terms.get(w, len(index.postings)) for w in words], np.int64)
        kept = index.promising(flat, np.array([0, 0]), np.array([len(flat), 0]), threshold)
        assert kept.tolist() == [0] or not want


def test_leaks_equal_containment(spark, tables):
    """Items stand in texts whole: exactly those documents are found."""
    items = tables["benchmark"].collect()
    want = {(d["doc_id"], i["item_id"]) for d in tables["documents"].collect() for i in items if i["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(tables["documents"], tables["benchmark"]).collect()}
    assert want and got == want


def test_joined_lists_find_what_broadcast_ones_find(spark, tables, monkeypatch):
    rows = lambda: sorted(tuple(r) for r in decontaminate.leaks(tables["documents"], tables["benchmark"]).collect())
    want = rows()
    kept = sorted(r["doc_id"] for r in decontaminate.drop_leaks(tables["documents"], tables["benchmark"]).collect())
    monkeypatch.setattr(decontaminate, "MAX_INDEX_CHARS", 900)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_CHARS", 0)
    monkeypatch.setattr(decontaminate, "TEXTS_PER_TASK", 3)
    got = rows()
    assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose([r[2:] for r in got], [r[2:] for r in want])
    left = decontaminate.drop_leaks(tables["documents"], tables["benchmark"])
    assert left.columns == tables["documents"].columns and sorted(r["doc_id"] for r in left.collect()) == kept
    odd = decontaminate.drop_leaks(docs(spark, [*ODD, (9, tables["benchmark"].first()["text"])]), tables["benchmark"])
    assert sorted(str(r["doc_id"]) for r in odd.collect()) == sorted(str(i) for i, _ in ODD)


def test_leak_edges(spark, monkeypatch):
    question, answer = "how many small stones did the old river carry down to the sea that year", "about seven thousand of them in a wet season"
    items = spark.createDataFrame(
        [(1, question, answer), (1, question, answer), (2, None, None), (3, "", "x"), (None, "what colour is the tall lighthouse on the western cape of the island", None)],
        "item_id int, text string, answer string",
    )
    filler = "entirely other words that say nothing at all " * 400
    rows = [
        *ODD, (10, f"{filler}{question.upper()}?! {answer}. {filler}"), (11, f"{filler}{question} {filler}{filler}"),
        (12, f"{question}, and {answer}"), (14, f"{filler}{question.replace('river', 'stream')} {answer.replace('wet', 'dry')} {filler}"), (13, "what colour is the tall lighthouse on the western cape of the island"),
    ]
    find = lambda: sorted(
        (r["doc_id"], r["m"]["item"]) for r in docs(spark, rows)
        .select("doc_id", F.explode(decontaminate.matches(F.col("text"), items, answer="answer")).alias("m")).where("doc_id > 6").collect()
    )
    found = [r for r in find() if r[1] is not None]
    assert found == [(10, 1), (10, 1), (12, 1), (12, 1), (14, 1), (14, 1)]  # 11 has the question only
    monkeypatch.setattr(decontaminate, "MAX_INDEX_CHARS", 60)
    assert [r for r in find() if r[1] is not None] == found
    assert decontaminate.drop_leaks(docs(spark, rows), items.drop("answer").limit(0)).count() == len(rows)
    assert decontaminate.drop_leaks(docs(spark, []), items).columns == docs(spark, []).columns
    assert decontaminate.leaks(docs(spark, []), items).count() == 0


def test_one_changed_word_hides_no_item(spark, tables):
    items = tables["benchmark"].collect()
    index = decontaminate.ItemIndex.build([(i["item_id"], *decontaminate.question_and_answer(i["text"])) for i in items], guessed=True)
    for item in items:
        words = item["text"].split()
        texts = [" ".join([*words[:i], "zzz", *words[i + 1 :]]) for i in range(len(words))]
        found = index.match(texts, decontaminate.RETRIEVE, decontaminate.OVERLAP, decontaminate.NGRAM)
        assert all(item["item_id"] in {hit["item"] for hit in row} for row in found), item
    # answers of their own: each part may have a changed word, none may be missing
    question = "which of the seven bridges over the wide river was first to be built of stone and iron"
    for answer, said, there in [
        ("the long one", "the short one", True), ("stone gate", "iron gate", True), ("eastgate", "westgate", False),
        ("the one at the mill below town", "the one at the inn below town", True), ("the long one", "nobody knows", False),
    ]:
        index = decontaminate.ItemIndex.build([(1, question, answer)] + [(n, f"item {n} about thing{n} and matter{n}", f"it is word{n}") for n in range(2, 9)])
        text = f"it was said: {question.replace('wide', 'broad')}? {said}"
        assert bool(index.match([text], decontaminate.RETRIEVE, decontaminate.OVERLAP, decontaminate.NGRAM)[0]) == there, answer
    # the same words in no order are no item
    short = decontaminate.ItemIndex.build([(1, "what colour is the tall lighthouse on the western cape", "")], guessed=True)
    assert short.match(["cape western the on lighthouse tall the is colour what"], 0.6, 0.5, 5) == [[]]


def test_scores_do_not_depend_on_the_number_of_indexes(spark, tables, monkeypatch):
    items = tables["benchmark"].collect()
    rng, texts = random.Random(5), []
    for i, item in enumerate(items):  # edited copies, around the threshold
        words = item["text"].split()
        texts.append((i, " ".join(w if rng.random() < 0.55 + 0.4 * (i % 10) / 10 else f"other{rng.randrange(99)}" for w in words)))
    find = lambda: {
        (r["doc_id"], r["item_id"]): (r["score"], r["question_overlap"], r["answer_overlap"], r["first_word"])
        for r in decontaminate.leaks(docs(spark, texts + [(10_000 + i, t["text"]) for i, t in enumerate(items)]), tables["benchmark"]).collect()
    }
    one = find()
    assert any(score < 0.9 for score, *_ in one.values())
    monkeypatch.setattr(decontaminate, "MAX_INDEX_CHARS", sum(len(i["text"]) for i in items) // 5)
    assert find() == one


# ------------------------------------------------------------- LM scores
def test_lm_base_scores_and_gain(spark, tables):
    got = {r["doc_id"]: r for r in maxent.score_documents(tables["documents"]).collect()}
    counts, rows = Counter(), tables["documents"].withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10).collect()
    for r in rows:
        if r["fold"]:
            counts.update([*r["text"].encode().lower().split(), b""])
    total = sum(counts.values())
    bottom = math.log10(total + 0.1 * (len(counts) + 1))
    for r in rows:
        words = [*r["text"].encode().lower().split(), b""]
        own = got[r["doc_id"]]
        assert own["held_out"] == (r["fold"] == 0) and own["n_tokens"] == len(words) and own["train_tokens"] == total
        assert own["n_known"] == sum(counts[w] > 0 for w in words)
        assert math.isclose(own["base_score"], sum(math.log10(counts[w] + 0.1) - bottom for w in words), rel_tol=1e-9)
    fresh = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in fresh) > sum(r["base_score"] for r in fresh)


def test_lm_edges(spark):
    rows = {(r["doc_id"], i): r for i, r in enumerate(maxent.score_documents(docs(spark, ODD)).collect())}
    assert len(rows) == len(ODD) and all(r["score"] < 0 for r in rows.values())
    assert {r["n_tokens"] for k, r in rows.items() if k[0] in (1, 2, 3)} == {1}
    assert next(r for r in rows.values() if r["doc_id"] is None)["held_out"] is False
    assert maxent.score_documents(docs(spark, [])).count() == 0
    held = [i for i in range(200) if (__import__("zlib").crc32(str(i).encode()) % 10) == 0][:2]
    alone = maxent.score_documents(docs(spark, [(held[0], "never seen"), (held[1], None)])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in alone)


def test_class_model_is_a_distribution_and_pieces_agree(monkeypatch):
    rng = np.random.default_rng(2)
    endings, starts = rng.integers(0, maxent.ENDINGS, 500), np.zeros(500, bool)
    starts[[0, 3, 4, 250]] = True
    table, bias = rng.normal(size=(maxent.CLASSES, maxent.ROWS)).astype(np.float32), np.zeros(maxent.CLASSES, np.float32)
    whole = maxent.features(endings, starts)
    logs = maxent.log_classes(whole, table, bias)
    assert np.allclose(np.exp(logs).sum(0), 1, atol=1e-5)
    plain = table[:, whole].sum(1)
    assert np.allclose(logs, plain - np.log(np.exp(plain).sum(0)), atol=1e-3)
    for i in (0, 3, 4, 5, 250, 251, 499):  # one token at a time
        first = max(j for j in np.flatnonzero(starts) if j <= i)
        back = [int(endings[i - k]) if i - k >= first else maxent.END_NUMBER for k in (1, 2, 3)]
        pair = (back[0] * 40503 + back[1] * 9973) % maxent.PAIRS
        assert whole[:, i].tolist() == [back[0], maxent.ENDINGS + back[1], 2 * maxent.ENDINGS + back[2], 3 * maxent.ENDINGS + pair]
    monkeypatch.setattr(maxent, "_TOKENS", 64)
    parts = np.concatenate([maxent.features(e, s)[:, new] for e, s, new in maxent._pieces(endings, starts)], axis=1)
    # only a start further back than the repeated tokens may be unseen, and that changes nothing
    assert (parts == whole).all()


def test_endings():
    words = [b"", b"a", b"abcd", b"xabcd", b"zabcd", b"bcd", "ción".encode(), b""]
    got = maxent.endings_of(words).tolist()
    assert got[0] == got[-1] == maxent.END_NUMBER and got[2] == got[3] == got[4] != got[5]
    for word, number in zip(words, got):
        assert number == (int.from_bytes(word[-4:][::-1], "little") * 2654435761 % 2**32) >> 19
    assert maxent.endings_of([]).tolist() == []


# ------------------------------------------------------------- the pipeline
def test_pipeline_stages(spark, tables, sf_dir):
    at = "/root/testdata/sf0.01"
    out = corpus_pipeline.run(spark, at)
    assert 0 < out.count() < tables["documents"].count() and out.select("doc_id").distinct().count() == out.count()
    known = out.join(tables["labels"], "doc_id")
    # few labels at this size: most, not all, of what should go goes
    total = tables["labels"].agg(F.sum(1 - F.col("quality")), F.sum("toxic")).first()
    assert known.where("quality = 0").count() <= total[0] * 0.1 and known.where("toxic = 1").count() <= total[1] * 0.3
    leaked = out.select("doc_id").join(decontaminate.leaks(tables["documents"], tables["benchmark"]), "doc_id")
    assert leaked.count() == 0


@pytest.mark.parametrize("rows", [[], ODD])
def test_pipeline_edges(spark, rows):
    at, frame = "/root/testdata/sf0.001", docs(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, at)
        if name != "byte_bpe":
            assert out.columns == frame.columns
        assert out.count() <= len(rows)


# ------------------------------------------------------------- language model against plain loops
def plain_rows(words, i):
    """Weight rows of token i of one document, one word at a time."""
    ending = lambda w: int(maxent.endings_of([w])[0])
    back = [ending(words[i - k]) if i >= k else maxent.END_NUMBER for k in (1, 2, 3)]
    pair = (back[0] * 40503 + back[1] * 9973) % maxent.PAIRS
    return [back[0], maxent.ENDINGS + back[1], 2 * maxent.ENDINGS + back[2], 3 * maxent.ENDINGS + pair]


def softmax(values):
    top = max(values)
    weights = [math.exp(v - top) for v in values]
    return [w / sum(weights) for w in weights]


def test_lm_scores_equal_plain_loops(spark, tables, monkeypatch):
    seen = {}

    def keep(name):
        real = getattr(maxent, name)
        monkeypatch.setattr(maxent, name, lambda *a, **k: seen.setdefault(name, real(*a, **k)))

    for name in ("classes_by_company", "_train"):
        keep(name)
    frame = tables["documents"].orderBy("doc_id").limit(60)
    got = {r["doc_id"]: r for r in maxent.score_documents(frame).collect()}
    documents = {r["doc_id"]: [*r["text"].encode().lower().split(), b""] for r in frame.collect()}
    counts = Counter(w for i, words in documents.items() if not got[i]["held_out"] for w in words)
    class_of, weights = seen["classes_by_company"], seen["_train"]
    kind = {w: int(class_of[maxent.endings_of([w])[0]]) for words in documents.values() for w in words}
    mass = np.zeros(maxent.CLASSES)
    for w, c in counts.items():
        mass[kind[w]] += c + maxent.PSEUDO
    mass += maxent.PSEUDO  # the unknown word of every class
    bias = np.log(mass / mass.sum())
    for i, words in documents.items():
        total = 0.0
        for at, w in enumerate(words):
            rows = plain_rows(words, at)
            chance = softmax([sum(float(weights[c, r]) for r in rows) + bias[c] for c in range(maxent.CLASSES)])
            total += math.log10(chance[kind[w]] * (counts[w] + maxent.PSEUDO) / mass[kind[w]])
        assert math.isclose(got[i]["score"], total, rel_tol=1e-5), i


def test_lm_training_equals_plain_loops(spark):
    rng = random.Random(2)
    documents = [[rng.choice([b"aa", b"bb", b"cc", b"dd"]) for _ in range(rng.randrange(1, 12))] + [b""] for _ in range(30)]
    class_of = np.ones(maxent.ENDINGS, np.int64)
    for k, w in enumerate((b"aa", b"bb", b"cc", b"dd")):
        class_of[maxent.endings_of([w])[0]] = 1 + k % 3
    class_of[maxent.END_NUMBER] = 0
    bias = np.log(np.full(maxent.CLASSES, 1 / maxent.CLASSES)).astype(np.float32)
    rows = [(bytearray(maxent.endings_of(words).astype("<u2").tobytes()),) for words in documents]
    got = maxent._train(spark.createDataFrame(rows, "endings binary").repartition(3), class_of, bias, 2)

    observed, weights = np.zeros((maxent.ROWS, maxent.CLASSES)), None
    tokens = [(plain_rows(words, i), int(class_of[maxent.endings_of([w])[0]])) for words in documents for i, w in enumerate(words)]
    for own, kind in tokens:
        for r in own:
            observed[r, kind] += 1
    share = np.exp(bias.astype(np.float64))
    prior = maxent.SMOOTH * share
    expected = observed.sum(1, keepdims=True) * share
    weights = 0.25 * np.log((observed + prior) / (expected + prior))
    start = sum(math.log(softmax(bias)[kind]) for _, kind in tokens)
    for _ in range(2):
        expected = np.zeros_like(observed)
        for own, _ in tokens:
            chance = softmax([weights[own, c].sum() + bias[c] for c in range(maxent.CLASSES)])
            for r in own:
                expected[r] += chance
        weights += maxent.RATE * (observed - expected) / ((observed + expected) / 2 + 2 * prior)
    assert np.allclose(got, weights.T, atol=1e-4)
    assert sum(math.log(softmax([weights[own, c].sum() + bias[c] for c in range(maxent.CLASSES)])[kind]) for own, kind in tokens) > start


# ------------------------------------------------------------- quality classifier and pipeline by brute force
def plain_statistics(text):
    text = text or ""
    words, lines, raw = text.split(), text.split("\n"), text.encode()
    n, size = max(len(words), 1), max(len(raw), 1)
    share = lambda chars: sum(b in chars for b in raw) / size
    pairs = list(zip(words, words[1:]))
    return [
        math.log1p(len(words)), sum(len(w) for w in words) / n, max([len(w) for w in words] or [0]),
        share(b"#$%&*|!@^~<>=+_{}[]\\/`"), share(b".,;:?'\"()-"), share(bytes(range(65, 91))), share(b"0123456789"),
        sum(b & 0xC0 == 0x80 for b in raw) / size, 1 - sum(len(w) for w in words) / max(len(text), 1),
        len(set(words)) / n, max([words.count(w) for w in set(words)] or [0]) / n,
        sum(a == b for a, b in pairs) / n, len(set(pairs)) / n, len(set(lines)) / len(lines),
        sum(w.isalpha() for w in words) / n, sum(w.isupper() for w in words) / n,
    ]


def test_quality_statistics_equal_plain_ones(tables):
    texts = [t for i, t in ODD if i != 5] + [r["text"] for r in tables["documents"].limit(60).collect()] + ["Ä ß 日本 <b>X</b>\n\n#1 #1"]
    for text in texts:
        assert np.allclose(quality.statistics(text), plain_statistics(text)), text


def leaf_gain(model, g, h, low, high):
    total, weight = sum(g[low:high]), sum(h[low:high])
    return total * total / (weight + model.ridge)


@pytest.mark.parametrize("seed", range(12))
def test_quality_trees_equal_all_splits_tried(seed):
    rng, model = np.random.default_rng(seed), quality.AdditiveModel()
    g, h = rng.normal(size=9), rng.random(9)
    leaves = [(0, 9)]
    for _ in range(2):  # greedily: of all splits of all leaves the one that gains most
        options = [(leaf_gain(model, g, h, a, c) + leaf_gain(model, g, h, c, b) - leaf_gain(model, g, h, a, b), a, c, b) for a, b in leaves for c in range(a + 1, b)]
        gain, a, c, b = max(options)
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, c), (c, b)]
    want = np.zeros(9)
    for a, b in leaves:
        want[a:b] = g[a:b].sum() / (h[a:b].sum() + model.ridge)
    assert np.allclose(model._tree(g, h), want)
    grid, weight = rng.normal(size=(4, 5)), rng.random((4, 5))
    value = lambda part, mass: part.sum() / (mass.sum() + model.ridge)
    best = None
    for i in range(1, 4):
        for j in range(1, 5):
            quarters = [(slice(a, b), slice(c, d)) for a, b in ((0, i), (i, 4)) for c, d in ((0, j), (j, 5))]
            gain = sum(grid[q].sum() * value(grid[q], weight[q]) for q in quarters) - grid.sum() * value(grid, weight)
            best = max(best or (-1, None), (gain, quarters), key=lambda found: found[0])
    want = np.zeros((4, 5))
    for q in best[1] if best[0] > 1e-9 else []:  # no split that gains is no step
        want[q] = value(grid[q], weight[q])
    gain, steps = model._quadrants(grid, weight)
    assert math.isclose(gain, max(best[0], 0.0)) and np.allclose(steps, want)


def test_pipeline_equals_its_stages_by_brute_force(spark, tables, reference):
    at = "/root/testdata/sf0.01"  # the tables of the fixture
    left = {r["doc_id"]: r for r in tables["documents"].collect()}
    frame = lambda: spark.createDataFrame(list(left.values()), tables["documents"].schema)
    good = quality.train(frame(), tables["labels"])
    left = {i: r for i, r in left.items() if good.score(np.array([plain_statistics(r["text"])]))[0] >= 0.3}
    toxic = toxicity.train(frame(), tables["labels"])
    left = {i: r for i, r in left.items() if toxic.document(r["text"])[0] < 0.5}
    ids = sorted(left)
    label = plain_components(np.array([plain_fingerprint(left[i]["text"]) for i in ids], np.uint64), 4)
    left = {i: left[i] for n, i in enumerate(ids) if label[n] == n}
    items = [r["text"] for r in tables["benchmark"].collect()]
    left = {i: r for i, r in left.items() if not any(item in r["text"] for item in items)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, at).collect()}
    assert got.keys() == left.keys() and len(left) < tables["documents"].count()
    for i, r in got.items():
        tokens = reference.encode_ordinary(left[i]["text"])
        assert r["n_tokens"] == len(tokens) and r["ids_sha256"] == hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(left[i]["text"].encode()).hexdigest()
