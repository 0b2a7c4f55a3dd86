"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

Generators with high recall propose spans: the four base kinds with and without a passing check, and looser
forms (phones without a plus, spelled-out and dotless e-mail addresses, addresses with bracketed dots, dotted
numbers of other lengths, cards with other separators). Boosted trees score each by its format and what
stands around it; a threshold per kind, calibrated on held-out candidates, selects. Base spans always stay;
selected others are added where they pass the check of their kind and overlap no base span.

Labels: a base match that passes its check is a positive. Negatives are candidates that fail it (version
numbers, short numbers, at-signs without a domain) and those that overlap a base span of another kind. All
other loose candidates have no label and only receive scores. A span has one label, and none twice. Neither
the check nor a phone's plus is a feature, so a kind is told by its shape and surroundings alone; where these do
not tell (a card by its digits without the checksum), no threshold is precise enough and nothing is added.

Training reads counts by feature values: per kind and half at most the product of SIZES, 94,500 rows, and far
fewer in practice, whatever the corpus. The trees become CASE expressions.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import table

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, made possessive or anchored where a run of characters can only match from its start.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser forms of a kind, which only the trees can select.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?|@)[A-Za-z0-9-]++(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.\[])[0-9]{1,5}(?:\[?\.\]?[0-9]{1,5}){2,7}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/]|[ -]{2})[0-9]{4}(?:[._/]|[ -]{2})[0-9]{4}(?:[._/]|[ -]{2})[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{2,4}\)?(?:[ .-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9-])",
}
#: Texts that may hold such a form.
MAY = {"email": r"[\[(]at[\])]|@", "ip": r"[0-9]\[?\.\]?[0-9]{1,5}\[?\.\]?[0-9]", "card": r"[0-9]{4}(?:[._/]|[ -]{2})[0-9]{4}", "phone": r"[0-9]{2}\)?[ .-]{1,2}\(?[0-9]{2}"}
#: Words before a span that often go with personal data, and with other numbers.
CUES = (r"(?i)\b(?:call|phone|tel|telephone|mobile|cell|fax|ring|dial|whatsapp|sms|contact|e-?mail|mail|write|card|visa|ip|host|server)\W{0,3}$", r"(?i)(?:\b(?:order|invoice|id|ref|reference|version|release|build|part|sku|isbn|issn|tracking|serial|no|nr|number|section|case|ticket|date|since|until|v)\W{0,3}|#)$")
#: Feature -> how many values it takes.
SIZES = {"digits": 21, "marks": 5, "letters": 2, "groups": 6, "before": 5, "after": 5, "cue": 3}
FEATURES = tuple(SIZES)
ROUNDS, RATE, DEPTH, PRECISION = 20, 0.5, 3, 0.95
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
SPAN = "struct<kind:int,start:int,stop:int,base:boolean,pattern:boolean,ok:boolean,digits:int,marks:int,letters:int,groups:int,before:int,after:int,cue:int>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, n - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """The check of a kind; loose forms are read as their base form would be written."""
    n = F.length(_digits(m))
    if kind == "ip":
        return F.regexp_replace(m, r"[\[\]]", "").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return m.rlike(r"(?:@|[\[(]at[\])]).*(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]")


def _class(c: Column) -> Column:
    """0 edge or white space, 1 letter, 2 digit, 3 quote or bracket, 4 other."""
    return (
        F.when((c == "") | c.rlike(r"^[ \t-\r]"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike(r"^[0-9]"), 2).when(c.rlike(r"^[\"'()\[\]<>|]"), 3).otherwise(4)
    )


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Matches with their places: what stands between matches and the matches give all offsets by their lengths."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    k = KINDS.index(kind)

    def step(acc: Column, i: Column) -> Column:
        m, gap, rest = F.element_at(acc["m"], i), F.element_at(acc["g"], i), F.element_at(acc["g"], i + 1)
        start = acc["at"] + F.length(gap)
        stop = start + F.length(m)
        n, letters = F.length(_digits(m)), F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
        ahead = F.right(gap, F.lit(16))
        fields = {
            "kind": F.lit(k), "start": start, "stop": stop, "base": F.lit(base) & _valid(kind, m), "pattern": F.lit(base), "ok": _valid(kind, m),
            "digits": F.least(n, F.lit(20)), "marks": F.least(F.length(m) - n - letters - F.when(m.startswith("+"), 1).otherwise(0), F.lit(4)), "letters": F.least(letters, F.lit(1)),
            "groups": F.least(F.regexp_count(m, F.lit("[0-9]+" if kind != "email" else r"\.|[\[(]dot")), F.lit(5)), "before": _class(F.right(gap, F.lit(1))), "after": _class(F.left(rest, F.lit(1))),
            "cue": F.when(ahead.rlike(CUES[0]), 1).when(ahead.rlike(CUES[1]), 2).otherwise(0),
        }
        span = F.struct(*[c.alias(name) for name, c in fields.items()]).cast(SPAN)
        wanted = n >= 7 if kind in ("card", "phone") else F.lit(True)
        return F.struct(acc["m"].alias("m"), acc["g"].alias("g"), stop.alias("at"), F.when(wanted, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    start = F.struct(found.alias("m"), gaps.alias("g"), F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda a: a["out"])).otherwise(none)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with `spans`: the base patterns' matches and loose ones that overlap none of their own kind; texts without
    a digit or an at sign are not searched."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digit, at = text.rlike("[0-9]"), text.contains("@")
    none = F.array().cast(f"array<{SPAN}>")
    fixed = [
        F.when(at, _spans(text, "email", PATTERN["email"], True)).otherwise(none),
        F.when(digit & text.rlike(r"[0-9]\.[0-9]"), _spans(text, "ip", PATTERN["ip"], True)).otherwise(none),
        F.when(digit, _spans(text, "card", PATTERN["card"], True)).otherwise(none),
        F.when(digit & text.contains("+"), _spans(text, "phone", PATTERN["phone"], True)).otherwise(none),
    ]
    loose = [F.when(text.rlike(MAY[k]), _spans(text, k, LOOSE[k], False)).otherwise(none) for k in KINDS]
    df = docs.withColumn("fixed", F.concat(*fixed)).withColumn("loose", F.concat(*loose))
    free = F.filter("loose", lambda s: ~F.exists("fixed", lambda b: (b["kind"] == s["kind"]) & _overlap(b, s)))
    return df.withColumn("spans", F.when(F.size("loose") > 0, F.concat("fixed", free)).otherwise(F.col("fixed"))).drop("fixed", "loose")


def boost(cells: list[tuple[tuple[int, ...], float, float]], rounds: int = ROUNDS, rate: float = RATE) -> list:
    """Gradient-boosted trees of depth DEPTH on weighted cells (features, positives, negatives), logistic loss.

    A tree is (feature, threshold, left, right) with leaves as numbers; "feature <= threshold" goes left."""
    score = [0.0] * len(cells)
    trees = []

    def grow(rows: list[int], depth: int):
        g = [cells[i][1] - (cells[i][1] + cells[i][2]) / (1 + math.exp(-score[i])) for i in rows]
        h = [(cells[i][1] + cells[i][2]) / (2 + math.exp(-score[i]) + math.exp(score[i])) for i in rows]
        total_g, total_h = sum(g), sum(h)
        leaf = rate * total_g / (total_h + 1)
        if depth == 0:
            return leaf
        best = (1e-9, None)
        for f in range(len(cells[0][0])):
            by: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for i, x, y in zip(rows, g, h, strict=True):
                by[cells[i][0][f]][0] += x
                by[cells[i][0][f]][1] += y
            left_g = left_h = 0.0
            for v in sorted(by)[:-1]:
                left_g, left_h = left_g + by[v][0], left_h + by[v][1]
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - total_g**2 / (total_h + 1)
                if gain > best[0]:
                    best = (gain, (f, v))
        if best[1] is None:
            return leaf
        f, v = best[1]
        return f, v, grow([i for i in rows if cells[i][0][f] <= v], depth - 1), grow([i for i in rows if cells[i][0][f] > v], depth - 1)

    for _ in range(rounds if cells else 0):
        tree = grow(list(range(len(cells))), DEPTH)
        trees.append(tree)
        score = [max(-30.0, min(30.0, s + predict([tree], c[0]))) for s, c in zip(score, cells, strict=True)]
    return trees


def predict(trees: list, x: tuple[int, ...]) -> float:
    total = 0.0
    for t in trees:
        while isinstance(t, tuple):
            t = t[2] if x[t[0]] <= t[1] else t[3]
        total += t
    return total


@dataclass(frozen=True)
class Model:
    """Trees and threshold of a kind, with what the held-out half says of them; shares are of labelled candidates."""

    trees: list
    threshold: float
    positives: int
    negatives: int
    precision: float
    recall: float


def _labelled(docs: DataFrame, text_col: str) -> DataFrame:
    """half and fields of the labelled candidates, with `label`. Texts split into a half for the trees and one for the threshold."""
    other = lambda s: F.exists("spans", lambda b: b["base"] & (b["kind"] != s["kind"]) & _overlap(b, s))
    marked = F.transform("spans", lambda s: F.struct(s.alias("s"), F.when(s["base"], 1).when(~s["ok"] | other(s), 0).alias("label")))
    c = candidates(docs, text_col).where(F.size("spans") > 0)
    return c.select(F.pmod(F.xxhash64(text_col), F.lit(2)).alias("half"), F.explode(marked).alias("m")).select("half", "m.s.*", "m.label").where("label is not null")


def calibrate(scored: list[tuple[float, float, float]], precision: float = PRECISION) -> tuple[float, float, float]:
    """(threshold, precision, recall): the lowest score from which on positives, with one of either class added to what
    was counted, reach the precision. So a few candidates do not calibrate anything, without a switch at some number."""
    total = sum(p for _, p, _ in scored)
    best, pos, neg = (math.inf, 0.0, 0.0), 0.0, 0.0
    ordered = sorted(scored, reverse=True)
    for k, (s, p, n) in enumerate(ordered):
        pos, neg = pos + p, neg + n
        if (k + 1 == len(ordered) or ordered[k + 1][0] < s) and (pos + 1) / (pos + neg + 2) >= precision:
            best = (s, pos / (pos + neg), pos / total if total else 0.0)
    return best


def fit(docs: DataFrame, text_col: str = "text") -> dict[int, Model]:
    """A model for each kind."""
    counts = _labelled(docs, text_col).groupBy("half", "kind", *FEATURES).agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    model = {}
    for k in range(len(KINDS)):
        half = [[(tuple(r[f] for f in FEATURES), float(r["pos"]), float(r["n"] - r["pos"])) for r in counts if r["kind"] == k and r["half"] == h] for h in (0, 1)]
        trees = boost(sorted(half[0]))
        threshold, precision, recall = calibrate([(predict(trees, x), p, n) for x, p, n in half[1]])
        model[k] = Model(trees, threshold, int(sum(p for h in half for _, p, _ in h)), int(sum(n for h in half for _, _, n in h)), precision, recall)
    return model


def _tree(tree, s: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(s[FEATURES[tree[0]]] <= tree[1], _tree(tree[2], s)).otherwise(_tree(tree[3], s))


def _selected(s: Column, model: dict[int, Model]) -> Column:
    out = F.lit(False)
    for k, m in model.items():
        if m.trees and m.threshold < math.inf:
            total = F.lit(0.0)
            for t in m.trees:
                total = total + _tree(t, s)
            out = F.when(s["kind"] == k, total >= m.threshold - 1e-9).otherwise(out)
    return out & s["ok"]


def find(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """docs with `base` and `all`: arrays of (kind, start, stop), sorted, in code points with the end exclusive.

    A null or empty text has none, a text is read whole whatever its length; ids are not read, so null and
    repeated ones do no harm; an empty table gives no rows and an empty model. Of added spans that overlap,
    the one that begins first stays, then the longer, then that of the kind listed first. Columns named spans,
    fixed, loose, more, base or all are replaced.
    """
    if model is None:
        model = fit(docs, text_col)
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    df = candidates(docs, text_col)
    df = df.withColumn("base", F.array_sort(F.transform(F.filter("spans", lambda s: s["base"]), plain)))
    more = F.filter("spans", lambda s: ~s["pattern"] & _selected(s, model) & ~F.exists("base", lambda b: _overlap(b, s)))
    df = df.withColumn("more", F.when(F.size("spans") > F.size("base"), F.array_distinct(F.transform(more, plain))).otherwise(F.array().cast("array<struct<kind:int,start:int,stop:int>>")))
    order = lambda s: F.struct(s["start"], -s["stop"], s["kind"])
    clear = F.filter("more", lambda s: ~F.exists("more", lambda o: _overlap(o, s) & (order(o) < order(s))))
    return df.withColumn("all", F.array_sort(F.concat("base", clear))).drop("spans", "more")


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])))


def redact(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """docs with each found span replaced by its kind in brackets; overlapping spans become one."""
    names, text = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), F.col(text_col)
    by_place = F.array_sort(F.transform("all", lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], -s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(by_place, start, step, lambda a: F.concat(F.concat_ws("", a["out"]), F.substring(text, a["at"] + 1, F.length(text))))
    return find(docs, text_col, model).withColumn(text_col, F.when(F.size("all") > 0, whole).otherwise(text)).drop("base", "all")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: (lambda s: s["kind"] == k)  # noqa: E731  a lambda of two parameters would get the place as its second
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))
