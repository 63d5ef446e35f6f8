"""Personal data by candidate boosting.

The base rules (e-mail, IP, payment card, phone) are always kept. Beside them, broad generators
propose spans that may overlap: numbers in any grouping as a card or a phone, disguised e-mail
addresses, dotted and colon-separated addresses. Boosted trees judge each proposal by its format and
context. The trees learn from the corpus itself: a proposal that a base rule confirms is
positive, one of a base rule's form that the rule rejects is negative; every positive is shown a second
time without the tell-tale marks of the base form (the plus, the at sign), so that other forms can
resemble it. Scores are calibrated by isotonic regression on proposals the trees have not seen, and a
kind's threshold is the smallest one at which at least ``PRECISION`` of those were right. Of the
proposals above it, the best ones that overlap neither a base span nor a better one are added.

Training, calibration and thresholds use the proposals of all documents. Proposals with the same features and verdict
train as one row that weighs as much as they do; thresholds come from running totals over all scores.

Defined results: NULL and empty texts hold nothing; repeated rows are searched one by one; if the documents
hold too few proposals of either sort, only the base rules apply; an empty table gives no
rows; other columns are ignored, unless they are named to be carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from ipaddress import IPv6Address

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.scale import running_totals
from basketry.session import cut, scratch_path

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_SUPPORT = 30  # confirmed held-out proposals that a threshold needs
CONTEXT = 40  # characters on either side
CHUNK = 2_000  # proposals that a task describes at a time

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

NUMBER = re.compile(r"(?<![\w.+])\+?\(?[0-9](?:[ ()./\t-]{0,3}[0-9]){6,22}(?!\w)")
DOTTED = re.compile(r"(?<![\w.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![\w])")
COLONS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
AT = re.compile(r"\s?[\[({<]\s?(?:at|AT|@)\s?[\])}>]\s?|\s(?:at|AT)\s|\s@\s")
DOT = r"(?:\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s)"
SPOKEN = re.compile(rf"[A-Za-z0-9-]+(?:(?:{DOT}|\.)[A-Za-z0-9-]+)*{DOT}[A-Za-z0-9-]+(?:(?:{DOT}|\.)[A-Za-z0-9-]+)*")
SOMETHING = re.compile(r"[0-9@]|\s(?:at|AT)\s|[\[({<]\s?(?:at|AT)")
WORDS = (
    re.compile(r"(?i)\b(?:phone|call|tel|fax|mobile|cell|whatsapp|sms)"),
    re.compile(r"(?i)\b(?:card|visa|master|amex|credit|debit|pay)"),
    re.compile(r"(?i)\b(?:mail|contact|write|reach|address)"),
    re.compile(r"(?i)\b(?:ip|host|server|node|login|address)\b"),
    re.compile(r"(?i)\b(?:version|release|order|invoice|isbn|doi|serial|ticket|build)\b"),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by the base rules, by kind and start."""
    spans, last, at = [], 0, text.find("@")
    while at >= 0:
        first = at
        while first > last and text[first - 1] in LOCAL:
            first -= 1
        if first < at and (found := DOMAIN.match(text, at + 1)):
            last = found.end()
            spans.append((0, first, last))
        at = text.find("@", max(at + 1, last))
    for found in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split(".")):
            spans.append((1, found.start(), found.end()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 13 and 13 <= len(d := _digits(found[0])) <= 19 and luhn(d):
            spans.append((2, found.start(), found.end()))
    for found in PHONE.finditer(text):
        if 9 <= len(_digits(found[0])) <= 15:
            spans.append((3, found.start(), found.end()))
    return spans


def proposals(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, trains): spans that may be personal data; they may overlap.

    ``trains`` marks the forms about which a base rule has an opinion.
    """
    found = []
    for m in NUMBER.finditer(text):
        plain = CARD.fullmatch(m[0]) is not None
        found += [(2, *m.span(), plain), (3, *m.span(), plain or m[0][0] == "+")]
    found += [(1, *m.span(), True) for m in DOTTED.finditer(text)]
    if "::" in text or text.count(":") > 2:
        found += [(1, *m.span(), False) for m in COLONS.finditer(text)]
    for m in AT.finditer(text):
        first = m.start()
        while first > 0 and m.start() - first < 64 and text[first - 1] in LOCAL:
            first -= 1
        if first < m.start() and (domain := SPOKEN.match(text, m.end())):
            found.append((0, first, domain.end(), False))
    at = text.find("@")
    while at >= 0:  # tokens around an at sign, whole or not
        first, last = at, at + 1
        while first > 0 and at - first < 64 and not text[first - 1].isspace():
            first -= 1
        while last < len(text) and last - at < 256 and not text[last].isspace():
            last += 1
        found.append((0, first, last, True))
        at = text.find("@", last)
    return found


FEATURES = 26


def features(text: str, kind: int, start: int, end: int, masked: bool = False) -> list[float]:
    """Format and context of a span; ``masked`` hides the plus and the at sign."""
    span = text[start:end]
    digits = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    address = re.sub(DOT, ".", AT.sub("@", span)) if kind == 0 else ""
    local, _, domain = address.partition("@")
    labels = domain.strip(".,;:!?").split(".")
    six = 0.0
    if ":" in span:
        try:
            six = float(bool(IPv6Address(span)))
        except ValueError:
            six = -1.0
    return [
        float(kind),
        float(len(digits)),
        float(len(groups)),
        float(max(groups)),
        float(min(groups)),
        float(len(span) - len(digits)),
        float(len({c for c in span if not c.isalnum()})),
        0.0 if masked else float(span.startswith("+")),
        0.0 if masked else float("@" in span),
        float("(" in span and ")" in span),
        float(kind == 2 and len(digits) >= 12 and luhn(digits)),
        float(kind == 1 and "." in span and all(g and len(g) <= 3 and int(g) <= 255 for g in span.split(".") if g.isdigit()) and len(groups) == 4),
        six,
        float(digits[:1] or -1),
        float(len(set(digits))),
        float(sum(c.isalpha() for c in span)),
        float(bool(local) and bool(domain)),
        float(len(labels) - 1),
        float(len(labels[-1]) if labels[-1].isalpha() else 0),
        float(bool(re.fullmatch(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", domain.rstrip(".,;:!?")))),
        float(bool(before[-1:].strip()) and before[-1:] not in "([<{\"'"),
        *(float(bool(w.search(before))) for w in WORDS),
    ]


def _hits_base(bases: list[tuple[int, int, int]], kind: int, start: int, end: int) -> bool:
    return any(k == kind and s < end and start < e for k, s, e in bases)


@dataclass
class Model:
    """Boosted trees as node arrays, the calibration steps, and a threshold for each kind."""

    trees: list[tuple] = field(default_factory=list)  # (weight, feature, threshold, left, right, value)
    bounds: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    levels: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    thresholds: dict[int, float] = field(default_factory=dict)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        for weight, feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (inner := left[node] >= 0).any():
                goes_left = rows[np.arange(len(rows)), np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            margin += weight * value[node]
        return np.interp(1 / (1 + np.exp(-2 * margin)), self.bounds, self.levels)

    def added(self, text: str, bases: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The proposals to keep besides the base spans."""
        if not self.thresholds:
            return []
        taken = [(s, e) for _, s, e in bases]
        free = [p for p in proposals(text) if p[0] in self.thresholds and not any(s < p[2] and p[1] < e for s, e in taken)]
        if not free:
            return []
        scores = self.scores(np.array([features(text, k, s, e) for k, s, e, _ in free]))
        kept = []
        for i in sorted(range(len(free)), key=lambda i: (-scores[i], free[i])):
            kind, start, end, _ = free[i]
            if scores[i] >= self.thresholds[kind] and not any(s < end and start < e for s, e in taken):
                taken.append((start, end))
                kept.append((kind, start, end))
        return kept


def _training_rows(docs: DataFrame) -> DataFrame:
    """(kind, label, features, n, held_out): the proposals of the documents, n of them alike."""

    def described(text: str) -> Iterator[tuple[int, float, list[float]]]:
        bases = base_spans(text)
        spans = [(k, s, e, _hits_base(bases, k, s, e)) for k, s, e, trains in proposals(text) if trains]
        spans += [(k, s, e, True) for k, s, e in bases]
        for kind, start, end, label in spans:
            for masked in (False, True) if label and kind in (0, 3) else (False,):
                yield kind, float(label), features(text, kind, start, end, masked)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, labels, rows = [], [], []

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(kinds, pa.int32()), pa.array(labels, pa.float64()), pa.array(rows, pa.list_(pa.float64()))]
            kinds.clear(), labels.clear(), rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["kind", "label", "features"])

        for batch in batches:
            for raw in batch[0]:
                text = raw.as_py() or ""
                for kind, label, row in described(text) if SOMETHING.search(text) else ():
                    kinds.append(kind)
                    labels.append(label)
                    rows.append(row)
                    if len(rows) >= CHUNK:
                        yield flush()
        yield flush()

    rows = docs.select("text").mapInArrow(compute, "kind int, label double, features array<double>")
    alike = rows.groupBy("kind", "label", "features").agg(F.count("*").alias("n"))
    return alike.withColumn("held_out", F.pmod(F.xxhash64("kind", "features"), F.lit(4)) == 0)


def _thresholds(unseen: DataFrame, bounds: np.ndarray, levels: np.ndarray) -> dict[int, float]:
    """Per kind the smallest calibrated score from which ``PRECISION`` of (kind, score, label, n) were right."""

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = pa.array(np.interp(batch["score"].to_numpy(zero_copy_only=False), bounds, levels))
            yield pa.RecordBatch.from_arrays([batch["kind"], level, batch["right"], batch["n"]], ["kind", "level", "right", "n"])

    right = (F.col("label").cast("long") * F.col("n")).alias("right")
    at_level = unseen.select("kind", "score", right, "n").mapInArrow(calibrate, "kind int, level double, right long, n long")
    at_level = cut(at_level.groupBy("kind", "level").agg(F.sum("right").alias("right"), F.sum("n").alias("n")))
    above = running_totals(at_level, {"level": -F.col("level")}, {"right": F.col("right"), "n": F.col("n")}, group=["kind"])
    enough = (F.col("right_running") >= LEAST_SUPPORT) & (F.col("right_running") >= PRECISION * F.col("n_running"))
    least = above.filter(enough).groupBy("kind").agg(F.min("level").alias("level"))
    return {r["kind"]: max(r["level"], PRECISION) for r in least.collect()}  # a row for each kind


def fit(docs: DataFrame, rounds: int = 15, depth: int = 4) -> Model:
    """Learn the trees, the calibration and the thresholds from all documents."""
    rows = cut(_training_rows(docs))
    learn = rows.filter("not held_out")
    counts = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_SUPPORT:
        return Model()
    vectors = learn.select("label", array_to_vector("features").alias("features"), F.col("n").cast("double").alias("weight"))
    fitted = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1, weightCol="weight").fit(vectors)
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "pii-trees")
    fitted.write().save(path)
    nodes: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(r["treeID"], []).append(r)
    trees = []
    for tree, weight in enumerate(fitted.treeWeights):
        ordered = sorted(nodes[tree], key=lambda r: r["id"])
        columns = [
            (r["split"]["featureIndex"], (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0], r["leftChild"], r["rightChild"], r["prediction"])
            for r in ordered
        ]
        trees.append((weight, *map(np.array, zip(*columns, strict=True))))
    unseen = fitted.transform(rows.filter("held_out").select("kind", "label", "n", array_to_vector("features").alias("features")))
    unseen = cut(unseen.select("kind", "label", "n", vector_to_array("probability")[1].alias("score")))
    if unseen.isEmpty():
        return Model()
    steps = IsotonicRegression(featuresCol="score", weightCol="weight").fit(unseen.withColumn("weight", F.col("n").cast("double")))
    model = Model(trees, np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray()))
    model.thresholds = _thresholds(unseen, model.bounds, model.levels)
    return model


FOUND = "base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>"


def _scan(docs: DataFrame, model: Model, carried: list[str], outputs, fields: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)  # some dozen small trees
    rows = docs.select(*carried, F.col("text").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch["_text"]:
                text = raw.as_py() or ""
                bases = base_spans(text) if SOMETHING.search(text) else []
                more = held.value.added(text, bases) if SOMETHING.search(text) else []
                found.append((text, bases, sorted([*bases, *more])))
            names, arrays = outputs(found)
            whole = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*whole.columns, *arrays], [*whole.schema.names, *names])

    return rows.mapInArrow(compute, f"{kept}, {fields}")


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _span_arrays(found):
    as_rows = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]
    return ["base", "spans"], [pa.array([as_rows(f[i]) for f in found], _SPAN) for i in (1, 2)]


def find(docs: DataFrame, model: Model, carried: list[str] | None = None) -> DataFrame:
    """(doc_id[, carried...], base, spans): offsets in code points, ends exclusive, by kind and start."""
    return _scan(docs, model, ["doc_id", *(carried or [])], _span_arrays, FOUND)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; touching or overlapping ones once."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """(carried..., redacted): whole texts with the found spans masked; NULL stays NULL."""
    with_text = docs.withColumn("_null", F.col("text").isNull())
    masked = _scan(
        with_text, model, [*carried, "_null"], lambda found: (["redacted"], [pa.array([mask(t, s) for t, _, s in found], pa.string())]), "redacted string"
    )
    return masked.withColumn("redacted", F.when(~F.col("_null"), F.col("redacted"))).drop("_null")
