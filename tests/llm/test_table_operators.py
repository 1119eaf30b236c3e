"""Operators on vectors, URLs, files and conversations against SQL and brute force."""

import math
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import difference  # noqa: E402
from foldergrid.llm import bpe, chat, licenses, registry, simhash, topk, url_filter  # noqa: E402
from foldergrid.llm import rules as rules_  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, registry.queries()[name], registry.oracle_sql()[name]) is None


# ------------------------------------------------------------- top-k
def plain_top(vectors, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vectors if i != q)
        out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def whole(v):
    return [math.floor(256 * x) for x in v]


def test_top_k_with_ties_and_crowds(spark, monkeypatch):
    monkeypatch.setattr(topk, "PART_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(200)]  # a third are copies
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5, pivots=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = [(i, whole(v)) for i, v in rows]
    want = plain_top(exact, [r for r in exact if r[0] % 50 == 0], 5)
    assert {q: sorted(v) for q, v in got.items()} == want


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0], "x"), (2, [0.5, 0.5], "x"), (3, None, "x"), (4, [nan, 1.0], "x"), (5, [1.0, inf], "x"), (6, [None, 1.0], "x"),
            (None, [9.0, 9.0], "x"), (2, [0.5, 0.5], "x"), (50, [], "x"), (100, [1e6, -1e6], "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    got = sorted(tuple(r) for r in topk.top_k(frame, frame.where("vec_id % 50 = 0"), 9).collect())
    usable = [(i, whole(v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = plain_top(usable, [r for r in usable if r[0] % 50 == 0], 9)
    assert got == sorted((q, *row) for q, found in want.items() for row in found)
    assert topk.top_k(frame.limit(0), frame, 3).count() == topk.top_k(frame, frame.limit(0), 3).count() == 0


# ------------------------------------------------------------- URLs
RULES = [("org/", "allow"), ("a.org/x/", "block"), ("a.org/x/y1", "allow"), ("a.org/x/y1", "block"), ("com", "block"), ("b.com/", "allow"), ("B.com/p", "block")]
URLS = [
    "http://a.org/x/z", "http://A.ORG/x/y12/3", "https://w.a.org/x", "http://b.com?p", "http://b.com/p?/q", "http://q.b.com/pp#x", "//c.com/",
    "http://c.com", "ftp://xa.org/", "http://", "http:///x", "", None, "no scheme", "http://org/", "http://a.org/x/", "http://a.org//x/", "http://b.com:80/p", "http://a.org/x/y1",
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    best = None
    for entry, verdict in RULES:
        h, slash, p = entry.partition("/")
        h, p = h.lower(), slash + p
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (h.count("."), len(p), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, entry, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("bound", [10**6, 0])
def test_urls(spark, monkeypatch, bound):
    monkeypatch.setattr(url_filter, "MAX_ENTRIES", bound)
    pages = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate([*URLS, URLS[0]])], "page_id int, url string, rule string, node string")
    rules = spark.createDataFrame([*RULES, (None, "block"), ("net/", None)], "entry string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, "url", rules).collect()}
    assert got == {i: plain_verdict(u) for i, u in enumerate([*URLS, URLS[0]])}
    assert {r["verdict"] for r in url_filter.judge_urls(pages, "url", rules.limit(0), "block").collect()} == {"block"}
    assert url_filter.judge_urls(pages.limit(0), "url", rules).count() == 0


# ------------------------------------------------------------- licences
def plain_best(matcher, text):
    words, best = licenses.words_of(text), 0.0
    for _, size, vector, _ in matcher.items:
        for start in range(max(len(words) - size, 0) + 1):
            best = max(best, matcher.cosine(words[start : start + size], vector))
    return best


def test_license_matches_equal_all_runs(spark, sf_dir):
    matcher = licenses.Matcher(licenses.TEMPLATES)
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += [f"// {t}\ncode code" for _, t in licenses.TEMPLATES] + [t.upper().replace(" ", "\n * ") for _, t in licenses.TEMPLATES]
    texts += ["the license", "licensed under", "license " * 50, "mit", "", None]
    found = 0
    for text in texts:
        best, hit = plain_best(matcher, text) if len(text or "") < 6000 or "icen" in text else 0.0, matcher.best(text)
        if best >= matcher.threshold:
            found += 1
            assert hit and math.isclose(hit[1], best, rel_tol=1e-8)
        elif len(text or "") < 6000:
            assert hit is None
    assert found > 20


def test_license_query(spark, sf_dir):
    rows = registry.license_scans(spark, sf_dir).collect()
    lines = {"Apache License, Version 2.0": "Apache-2.0", "General Public License, version 3": "GPL-3.0-only", "under the MIT License": "MIT", "under CC BY-NC 4.0": "CC-BY-NC-4.0"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        named = {name for line, name in lines.items() if line in texts[r["doc_id"]]}
        assert (r["own_license"] in named) if named else r["own_license"] is None
    own = {}
    for r in rows:
        if r["own_license"] and r["path"].rsplit("/", 1)[-1].startswith("LICENSE"):
            own.setdefault(r["path"].rsplit("/", 1)[0], []).append((-r["own_score"], r["own_license"]))
    for r in rows:
        up = r["path"].split("/")[:-1]
        above = ["/".join(up[:n]) for n in range(len(up), 0, -1)]
        near = next((d for d in above if d in own), None)
        assert r["license"] == (r["own_license"] or (near and min(own[near])[1]))
        assert r["license_from"] == (None if r["own_license"] else near)


def test_license_edges(spark):
    mit, gpl = "Released under the MIT License", "This work is licensed under the GNU General Public License, version 3"
    rows = [
        ("LICENSE", mit), ("a/b/COPYING.txt", gpl), ("a/b/COPYING.txt", gpl), ("a/x.py", None), ("a/b/c/d/y.py", ""), ("a/b/z.py", f"# {mit}\n" + "x = 1\n" * 50_000),
        ("top.py", "x"), (None, "y"), ("a/b/c/LICENSE", "no licence text"), ("", None),
    ]
    frame = spark.createDataFrame([(p, t, "mine") for p, t in rows], "path string, text string, license string")
    got = [(r["path"], r["license"], r["license_from"]) for r in licenses.scan(frame).collect()]
    assert sorted(got, key=str) == sorted([
        ("LICENSE", "MIT", None), ("a/b/COPYING.txt", "GPL-3.0-only", None), ("a/b/COPYING.txt", "GPL-3.0-only", None), ("a/x.py", "MIT", ""),
        ("a/b/c/d/y.py", "GPL-3.0-only", "a/b"), ("a/b/z.py", "MIT", None), ("top.py", "MIT", ""), (None, None, None), ("a/b/c/LICENSE", "GPL-3.0-only", "a/b"), ("", "MIT", ""),
    ], key=str)
    assert licenses.scan(frame.limit(0)).count() == 0


def test_members_of_a_family_are_told_apart():
    matcher = licenses.Matcher(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES:
        assert matcher.best(f"/* {text} */ int main")[0] == name
    header = (
        "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the "
        "Free Software Foundation; either version {} of the License, or (at your option) any later version."
    )
    for thing, family, version, name in [
        ("program", "General Public License", "2", "GPL-2.0"), ("program", "General Public License", "3", "GPL-3.0"),
        ("library", "Lesser General Public License", "2.1", "LGPL-2.1"), ("library", "Lesser General Public License", "3", "LGPL-3.0"),
        ("program", "Affero General Public License", "3", "AGPL-3.0"), ("library", "Library General Public License", "2", "LGPL-2.0"),
    ]:
        assert matcher.best(header.format(thing, family, version))[0] == f"{name}-or-later"
    bsd = next(text for name, text in licenses.TEMPLATES if name == "BSD-3-Clause")
    assert matcher.best(bsd.replace("the copyright holder nor", "Example Company nor").replace("1.", "*").replace("3.", "*"))[0] == "BSD-3-Clause"
    assert matcher.best("Licensed under CC BY-NC-SA 4.0")[0] == "CC-BY-NC-SA-4.0"
    assert matcher.best("Licensed under the Apache License, Version 1.1") is None


def test_license_file_names(spark):
    mit, apache = "Released under the MIT License", "Licensed under the Apache License, Version 2.0"
    rows = [("a/LICENSE-MIT", mit), ("a/LICENSE-APACHE", apache), ("a/b/x.py", "x"), ("c/MIT-LICENSE.txt", mit), ("c/x.py", "x"), ("d/LICENSE_1_0.txt", apache),
            ("d/x.py", "x"), ("e/license_checker.py", mit), ("e/licensee", mit), ("e/x.py", "x"), ("f/LICENSE.Apache", apache), ("f/x.py", "x")]
    got = {r["path"]: r["license"] for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    # of two in one directory the higher score, then the smaller name
    assert {p: got[p] for p in got if p.endswith("x.py")} == {
        "a/b/x.py": "Apache-2.0", "c/x.py": "MIT", "d/x.py": "Apache-2.0", "e/x.py": None, "f/x.py": "Apache-2.0",
    }


# ------------------------------------------------------------- chat
def plain_views(turns, part_chars):
    out = {}
    for conversation in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conversation), key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] or ""))
        for who in {t[2] for t in own} - {None, "system"}:
            before = 0
            for _, _, speaker, text in own:
                text = text or ""
                part = before // part_chars
                before += len(text) + chat.TURN_ALLOWANCE
                view = out.setdefault((conversation, who, part), ["", [], 0])
                name = "assistant" if speaker == who else "system" if speaker == "system" else "user" if speaker is None else f"user name={speaker}"
                head = f"<|im_start|>{name}\n"
                if speaker == who:
                    view[1].append((len(view[0]) + len(head), len(view[0]) + len(head) + len(text) + 10))
                view[0] += f"{head}{text}<|im_end|>\n"
                view[2] += 1
    return {k: (v[0], v[1], v[2]) for k, v in out.items()}


@pytest.mark.parametrize("part_chars", [1 << 20, 200])
def test_chat(spark, part_chars):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", None), (1, 3, "ann", "ünï"), (1, 4, None, "who?"), (1, 4, None, "who?"), (1, 5, "cy", ""),
        (2, 0, "system", "alone"), (None, 1, "ann", "a"), (None, None, "bob", "b" * 500), (3, 0, "ann", "x" * 100_000),
        *[(4, i, ("ann", "bob", "cy")[i % 3], f"turn {i}") for i in range(400)],
    ]
    frame = spark.createDataFrame([(*t, 1, "p") for t in turns], "conv_id bigint, turn int, role string, text string, part int, perspective string")
    got = {(r["conv_id"], r["perspective"], r["part"]): (r["rendered"], [tuple(s) for s in r["spans"]], r["n_turns"]) for r in chat.rotate(frame, part_chars=part_chars).collect()}
    assert got == plain_views(turns, part_chars)
    assert chat.rotate(frame.limit(0)).count() == 0


def test_chat_is_native(spark, sf_dir):
    plan = registry.chat_rotation(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------- names that operators use themselves
def test_columns_may_have_any_names(spark):
    """Columns named like those that an operator works with come back as they were."""
    own = ["_row_number", "_fingerprint", "_host", "_found", "_path", "_encoded", "_dir", "_m", "_page", "_file", "_id", "_row", "_of", "_from", "c0"]
    rows = [(i, f"some words of text number {i % 2}", f"a/{i}.txt", "http://x.org/a", *[100 * i + n for n in range(len(own))]) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, path string, url string, " + ", ".join(f"`{c}` int" for c in own))
    want = {r[0]: r[4:] for r in rows}
    rules = spark.createDataFrame([("x.org/", "block")], "entry string, verdict string")
    results = {
        "simhash": simhash.keep_one(frame), "licenses": licenses.scan(frame), "urls": url_filter.judge_urls(frame, "url", rules),
        "bpe": bpe.encode_and_decode(frame, "text", registry.VOCABULARY), "rules": rules_.keep(frame.withColumns({"lang": F.lit("x"), "source": F.lit("y")})),
    }
    for name, result in results.items():
        got = {r["doc_id"]: tuple(r[c] for c in own) for r in result.collect()}
        assert all(got[i] == want[i] for i in got) and (got or name == "rules"), name


def test_license_identifier_lines():
    matcher = licenses.Matcher(licenses.TEMPLATES)
    for text, name in (
        ("# SPDX-License-Identifier: MIT\n", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-only */ int x;", "GPL-2.0-only"),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode", "(MIT OR Apache-2.0) AND BSD-3-Clause"),
        ("a b\nSPDX-License-Identifier:  Apache-2.0   WITH  LLVM-exception", "Apache-2.0 WITH LLVM-exception"),
    ):
        found = matcher.best(text)
        assert found[0] == name and found[1] == 1.0 and licenses.words_of(text)[found[2]] == b"spdx"
        assert licenses.words_of(text)[found[2] : found[3]][3:] == licenses.words_of(name)
    assert matcher.best("SPDX-License-Identifier: ") is None and matcher.best("SPDX-License-Identifier") is None and matcher.best(None) is None
