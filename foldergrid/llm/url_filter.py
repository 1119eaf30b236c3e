"""URL filter: allow and block entries in a trie over reversed host labels and path segments.

An entry is a host with an optional path prefix (`example.org/en/1`). It fits its host and
all subdomains if the URL's path starts with the entry's path. The longest match wins: more
host labels first, then the longer path; of an allow and a block entry of the same text the
block entry wins. A URL without a fitting entry gets the default verdict.

Edge cases: a null URL, or one without `://`, has an empty host and an empty path and gets
the default verdict. A host is compared label by label as written, port and user included;
only A-Z are lower-cased. Repeated rows give repeated rows; no entries mean the default
verdict everywhere. Columns of the input other than the URL are kept; `host`, `path`, `rule`
and `verdict` are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# entries a broadcast trie may hold, and their characters (a few hundred MB of Python objects)
MAX_ENTRIES, MAX_CHARS = 1_000_000, 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; else empty."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def split_entry(entry: str) -> tuple[list[str], list[str], str]:
    """(host labels from the last to the first, whole path segments, start of the next one)."""
    host, slash, path = entry.partition("/")
    labels = host.translate(str.maketrans(_UPPER, _LOWER)).split(".")[::-1]
    if not slash:
        return labels, [], ""
    *whole, rest = ("/" + path).split("/")
    return labels, whole, rest


class Trie:
    """Nodes are dictionaries. Host labels lead to nodes; the key None of a host node is the
    root of its paths. A path node holds whole segments as keys and, under None, the entries
    that end inside the next segment as {start of the segment: (entry, verdict)}."""

    def __init__(self, entries: list[tuple[str, str]]):
        self.root: dict = {}
        for entry, verdict in entries:
            labels, whole, rest = split_entry(entry)
            node = self.root
            for label in labels:
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            if ends.get(rest, ("", ALLOW))[1] != BLOCK:
                ends[rest] = (entry, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(entry, verdict) of the longest match."""
        best, node = None, self.root
        segments = path.split("/") if path else []
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = _longest(node[None], segments) or best
        return best


def _longest(node: dict, segments: list[str]) -> tuple[str, str] | None:
    """The longest path entry below a host. Segments come from splitting at `/`: the first is
    the empty one before the leading slash."""
    best = None
    for i in range(len(segments) + 1):
        ends = node.get(None)
        if ends:
            text = segments[i] if i < len(segments) else ""
            if i == 0 or i < len(segments):
                for stop in range(len(text) + 1):
                    best = ends.get(text[:stop], best)
        if i == len(segments):
            break
        node = node.get(segments[i])
        if node is None:
            break
    return best


def judge_urls(pages: DataFrame, url: str, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`.

    `rules` has the columns `entry` and `verdict` ('allow' or 'block'). Its size is measured:
    a list within the bounds is broadcast as a trie, a longer one is joined.
    """
    rules = rules.select("entry", "verdict").where("entry IS NOT NULL AND verdict IN ('allow', 'block')")
    count, chars = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("entry")), F.lit(0))).first()
    url_column = F.col(f"`{url}`")
    # the input's own columns travel in one struct, so none of their names matters
    page = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    named = pages.select(page.alias("_page"), host_of(url_column).alias("_host"), path_of(url_column).alias("_path"))
    if count <= MAX_ENTRIES and chars <= MAX_CHARS:
        judged = _by_trie(named, [tuple(r) for r in rules.collect()])
    else:
        judged = _by_join(named, rules)
    return judged.select(
        *[F.col("_page").getField(c).alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_found.entry").alias("rule"),
        F.coalesce("_found.verdict", F.lit(default)).alias("verdict"),
    )


def _by_trie(named: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    shared = named.sparkSession.sparkContext.broadcast(Trie(entries))
    kind = pa.struct([("entry", pa.string()), ("verdict", pa.string())])

    @F.arrow_udf("entry string, verdict string")
    def found(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        find = shared.value.find
        hits = map(find, hosts.to_pylist(), paths.to_pylist())
        return pa.array([hit and {"entry": hit[0], "verdict": hit[1]} for hit in hits], kind)

    return named.withColumn("_found", found("_host", "_path"))


def _by_join(named: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by equal keys: an entry is keyed by its trie node, reversed host and whole
    segments, and every distinct (host, path) looks up the nodes on its way."""
    @F.arrow_udf("struct<node: string, rest: string, labels: int>")
    def place(entries: pa.Array) -> pa.Array:
        rows = []
        for entry in entries.to_pylist():
            labels, whole, rest = split_entry(entry)
            node = ".".join(labels) + "|" + "/".join(whole) + ("/" if whole else "")
            rows.append({"node": node, "rest": rest, "labels": len(labels)})
        return pa.array(rows, pa.struct([("node", pa.string()), ("rest", pa.string()), ("labels", pa.int32())]))

    keyed = rules.withColumn("_place", place("entry")).select("entry", "verdict", "_place.*")
    sites = named.select("_host", "_path").distinct()
    labels = F.reverse(F.split("_host", r"\."))
    parts = F.split("_path", "/")
    hosts = sites.withColumn("_labels", labels).withColumn("_parts", parts).select(
        "_host", "_path", "_parts", F.explode(F.expr("transform(sequence(1, size(_labels)), n -> array_join(slice(_labels, 1, n), '.'))")).alias("_h")
    )
    # `rest` of a node is matched against the segment that follows; the empty node also fits an empty path
    nodes = hosts.select(
        "_host", "_path",
        F.explode(F.expr(
            "transform(sequence(0, size(_parts) - 1), n -> named_struct("
            "'node', concat(_h, '|', array_join(slice(_parts, 1, n), '/'), if(n > 0, '/', '')), 'next', _parts[n]))"
        )).alias("_n"),
    )
    hits = nodes.join(keyed, F.col("_n.node") == F.col("node")).where(F.startswith(F.col("_n.next"), F.col("rest")))
    rank = F.struct("labels", F.length("entry").alias("size"), (F.col("verdict") == BLOCK).alias("blocks"), "entry", "verdict")
    best = hits.groupBy("_host", "_path").agg(F.max(rank).alias("_best")).select(
        F.col("_host").alias("_bh"), F.col("_path").alias("_bp"),
        F.struct(F.col("_best.entry").alias("entry"), F.col("_best.verdict").alias("verdict")).alias("_found"),
    )
    return named.join(best, (F.col("_host") == F.col("_bh")) & (F.col("_path") == F.col("_bp")), "left").drop("_bh", "_bp")
