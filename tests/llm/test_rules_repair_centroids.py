"""Quality rules, conversation repair and centroid clustering against plain models."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldergrid.llm import centroids, registry, repair, rules
from foldergrid.llm.repair import BLANK, DUPLICATE, FINE, TRUNCATED, Costs, Lattice


# ------------------------------------------------------------- quality rules
def plain_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice))


TEXTS = [
    None, "", "  \n\t ", "a", "a b c a b c", "a a a a a", "x\x0by\x0cz", "eins zwei drei\neins zwei drei\n\nvier", "für 𝒳 # |x| <b>",
    "no break space here", "a b c d a b c e a b", "\n".join(["same line here"] * 5), "w " * 3000,
]


def test_counts_of_single_texts(spark):
    rows = [(i, t, "en", "s", -1) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = {r["doc_id"]: tuple(r)[1:7] for r in rules.judge(frame).collect()}
    for i, t in enumerate(TEXTS):
        counts = plain_counts(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert got[i] == (*counts, failed), t


def prose(rng, n, extra=""):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.choice((4, 5, 5, 6)))) + extra for _ in range(n))


def test_cutoffs_follow_the_group(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 60), "en", "plain") for i in range(150)]
    rows += [(1000 + i, prose(rng, 60, "#"), "en", "code") for i in range(150)]  # symbols are usual there
    rows += [(2000, prose(rng, 60, "#"), "en", "plain"), (2001, prose(rng, 60, "abcdef"), "en", "plain")]
    rows += [(3000, prose(rng, 60), None, None), (3001, prose(rng, 60, "#"), "en", "rare"), (3000, prose(rng, 60), None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumns({"_row": F.lit(77), "kept": F.lit("mine"), "_group0": F.lit(1), "measure": F.lit("m")})
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(frame).collect()}
    assert all(kept[i] for i in range(150)) and all(kept[1000 + i] for i in range(150))
    assert not kept[2000] and not kept[2001] and kept[3000]
    left = rules.keep(frame)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in rows if kept[r[0]])
    assert {(r["_row"], r["kept"]) for r in left.select("_row", "kept").collect()} == {(77, "mine")}
    assert rules.judge(frame.limit(0)).count() == rules.keep(frame.limit(0)).count() == 0


def test_sketches_merge(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice("xy"), rng.randrange(100000)) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "g string, h string, value long").withColumn("measure", F.lit("m"))
    code = F.expr(rules._code("value")).alias("code")
    fine = frame.groupBy("g", "h", "measure", code).agg(F.count(F.lit(1)).alias("n"))
    direct = frame.groupBy("measure", code).agg(F.count(F.lit(1)).alias("n"))
    assert sorted(rules.merged(fine, []).collect()) == sorted(direct.collect())
    found = rules.quantiles(direct, [], "").first()["_q"]
    values = sorted(r[2] for r in rows)
    assert found["total"] == 4000
    for got, exact in ((found["low"], values[399]), (found["mid"], values[1999])):
        assert got <= exact <= got * (1 + 1 / 64) + 1
    bins = spark.range(0, 5000).select("id", F.expr(rules._code("id")).alias("code")).withColumn("low", F.expr(rules._least("code"))).orderBy("id").collect()
    assert all(b["code"] <= c["code"] for b, c in zip(bins, bins[1:])) and all(b["low"] <= b["id"] for b in bins)


def test_rules_run_without_python(spark, sf_dir):
    frame = rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- conversation repair
VALID = re.compile(r"(s?(ua)+)?\Z")


def plain_repair(turns, costs, most_inserts):
    """The cheapest edits by trying all of them: (cost, audit, repaired text). `turns` holds
    (role, text, fault)."""
    best = None
    for inserts in range(most_inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(turns) + 1), inserts):
            options = []
            for i, (role, text, fault) in enumerate(turns):
                options += [[("I", costs.insert, "user", ""), ("I", costs.insert, "assistant", "")]] * places.count(i)
                more = costs.truncated if fault == TRUNCATED else 0
                edits = [("D", costs.delete, None, None)]
                if fault not in (BLANK, DUPLICATE):
                    edits += [("K", costs.keep + more, role, text), ("R", costs.rerole + more, "user", text), ("R", costs.rerole + more, "assistant", text)]
                options.append(edits)
            options += [[("I", costs.insert, "user", ""), ("I", costs.insert, "assistant", "")]] * places.count(len(turns))
            for chosen in itertools.product(*options):
                if VALID.match("".join(r[:1] or "?" for _, _, r, _ in chosen if r is not None)):
                    said = "\n".join(f"{r}:{t}" for _, _, r, t in chosen if r is not None)
                    candidate = (sum(c[1] for c in chosen), "".join(c[0] for c in chosen), said)
                    best = candidate if best is None else min(best, candidate)
    return best


def by_lattice(turns, costs=Costs()):
    lattice = Lattice(costs)
    for turn in turns:
        lattice.read(*turn)
    return lattice.result()


turn_lists = st.lists(
    st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b", ""]), st.sampled_from([FINE, FINE, BLANK, DUPLICATE, TRUNCATED])),
    max_size=5,
)


@settings(max_examples=150, deadline=None)
@given(turn_lists)
def test_repair_equals_all_edits_tried(turns):
    cost, audit, said = plain_repair(turns, Costs(), 2)
    assert by_lattice(turns) == (cost, audit, hashlib.sha256(said.encode()).hexdigest())


@settings(max_examples=60, deadline=None)
@given(st.lists(turn_lists.flatmap(lambda t: st.sampled_from(t) if t else st.just(("user", "a.", FINE))), max_size=3), st.integers(1, 4))
def test_repair_with_cheap_insertions(turns, insert):
    costs = Costs(insert=insert, delete=3)
    cost, audit, said = plain_repair(turns, costs, 4)
    assert by_lattice(turns, costs) == (cost, audit, hashlib.sha256(said.encode()).hexdigest())


def test_blocks_do_not_change_the_repair(monkeypatch):
    rng = random.Random(3)
    turns = [(rng.choice(["user", "assistant", "system", "x"]), f"t{i}.", rng.choice([FINE, FINE, FINE, BLANK, TRUNCATED])) for i in range(400)]
    found = set()
    for block in (1, 2, 7, 128, 1000):
        monkeypatch.setattr(repair, "BLOCK", block)
        found.add(by_lattice(turns))
    assert len(found) == 1 and len(found.pop()[1]) == 400


def plain_audit(rows):
    """rows: (conv, turn, role, text, present); the whole operator, one conversation at a time."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x, p in rows if c == conv and p),
                      key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
        seen, turns = set(), []
        for _, role, text in mine:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = BLANK if not shown else DUPLICATE if (role, text) in seen else FINE if shown[-1] in ".!?" else TRUNCATED
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for r, _, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, said = plain_repair(turns, Costs(), 0) if len(turns) < 9 else (None, None, None)
        faults = [sum(f == kind for _, _, f in turns) for kind in (BLANK, DUPLICATE, TRUNCATED)]
        out[conv] = (gaps, *faults, illegal, cost, audit, None if said is None else hashlib.sha256(said.encode()).hexdigest())
    return out


def test_query_on_whole_conversations(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    rows = []
    for r in turns:
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in r["text"] if c not in ".!?") if kind == 2 else r["text"]
        rows += [(r["conv_id"], r["turn"], "user" if kind == 4 else r["role"], text, kind != 0)] * (2 if kind == 3 else 1)
    want = plain_audit(rows)
    found = registry.conversation_repair(spark, sf_dir)
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == want.keys() == {r["conv_id"] for r in turns}
    assert {c: got[c] for c in got if want[c][6] is not None} == {c: want[c] for c in got if want[c][6] is not None}
    damaged = registry.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")).where("present")
    mended = repair.repaired_turns(damaged, found).orderBy("conv_id", "place").collect()
    said = {c: "" for c in got}
    for c, group in itertools.groupby(mended, key=lambda r: r["conv_id"]):
        said[c] = "\n".join(f"{r['role']}:{r['text']}" for r in group)
    assert {c: hashlib.sha256(x.encode()).hexdigest() for c, x in said.items()} == {c: row[7] for c, row in got.items()}


def test_repair_edges(spark):
    rows = [
        (1, None, "user", "first."), (1, 1, None, "x."), (1, 1, "user", None), (None, 5, "user", "q?"), (None, 9, "assistant", "a!"), (None, 9, "assistant", "a!"),
        (2, None, "user", " \t"), (3, 0, "user", "lang " * 50_000 + "."), (3, 1, "assistant", "ok."),
    ]
    rows = [(c, t, r, x, True, 1, "y") for c, t, r, x in rows] + [(4, 0, "user", "gone.", False, 1, "y"), (5, 0, "user", "gone.", None, 1, "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, there boolean, gaps int, conv string")
    found = repair.audits(frame, present="there")
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == plain_audit([(c, t, r, x, p) for c, t, r, x, p, _, _ in rows])
    assert got[4] == got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.audits(frame.limit(0)).count() == 0


def test_inserted_turns_are_written(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c.")], "conv_id long, turn long, role string, text string")
    costs = Costs(rerole=9, delete=9, insert=1)
    found = repair.audits(frame, costs=costs)
    assert found.first()["audit"] == "KIKK"
    mended = repair.repaired_turns(frame, found).orderBy("place").collect()
    assert [(r["edit"], r["turn"], r["role"], r["text"]) for r in mended] == [
        ("K", 0, "user", "a."), ("I", None, "assistant", ""), ("K", 1, "user", "b."), ("K", 2, "assistant", "c.")]


# ------------------------------------------------------------- centroid clustering
def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in first[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (apart(v, centres[c]), c))
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, v in kept:
            groups[nearest(v)].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    return sorted(((i, nearest(v), apart(v, centres[nearest(v)])) for i, v in kept), key=str), centres


@pytest.mark.parametrize("k,rounds", [(1, 2), (4, 3), (8, 10)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.integers(-3, 4, 5) / 512).tolist()) for i in range(200)] + [(7, [0.0] * 5)] * 3 + [(None, [1.0] * 5)]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, [1.0]), (902, [nan] * 5), (903, [inf, 0.0, 0.0, 0.0, 0.0]), (904, [None, 0.0, 0.0, 0.0, 0.0]), (905, [])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, v int").repartition(5)
    got, centres = centroids.cluster(frame, dims=5, k=k, rounds=rounds)
    want, final = plain_clusters(rows, k, rounds, 5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and centres == final
    digests = centroids.with_digests(got, centres).collect()
    assert {r["inertia"] for r in digests} == {sum(d for _, _, d in want)}


def test_zero_favours_the_smaller_number():
    tournament = centroids.Bisectors([[0, 0], [2, 0], [0, 2], [2, 0]])
    assert tournament.nearest(np.array([[1, 0], [1, 1], [2, 0], [0, 1], [9, 0]])).tolist() == [0, 0, 1, 0, 1]


def test_cluster_edges(spark):
    frame = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got, centres = centroids.cluster(frame, dims=2, k=8)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 0), (2, 0, 0)] and len(centres) == 2
    empty = centroids.with_digests(*centroids.cluster(frame.limit(0), dims=2))
    assert empty.count() == 0 and "centroid_sha256" in empty.columns
    huge = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large to cluster"):
        centroids.cluster(huge, dims=2)
