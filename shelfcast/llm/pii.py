"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

Strict patterns give the base spans, which always stay. Looser patterns give further candidates (masked addresses,
numbers in unusual spelling or with a wrong check digit). On every span six labelers vote or abstain: pattern, check
digits and ranges, gazetteer, words before it, words that speak against it, and what touches it. The counts of all
vote patterns, over all documents, go through expectation-maximisation, which estimates how reliable each labeler
is and how likely each pattern marks personal data. With those likelihoods as labels a logistic span classifier is
fitted to features of the spans, again on the counts of all of them; candidates it holds likely are added. Votes and
features are a few bits, so the counts are bounded tables whatever the input.

Spans are code points, the end exclusive; those of one kind never overlap. Defined results: a null or empty text has
no spans. Rows are independent, but for the reliabilities: null ids and repeated rows are rows like others, an empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Least probability at which the classifier adds a candidate.
ADDED = 0.9
LABELERS = 6
AGAINST, ABSTAIN, FOR = -1, 0, 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match takes whole runs of digits, so none can begin inside a run that failed
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_LOOSE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\(\[\{<]at[\)\]\}>] ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:\.|[\(\[\{<]dot[\)\]\}>]) ?[A-Za-z0-9-]{1,63}){1,4}"
    ),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]?[0-9]{4}){2}[ ./_-]?[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:(?:\+|00)[1-9][0-9]{0,2}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
_BEFORE = {
    "email": re.compile(r"e-?mail|contact|write|reach|correo|courriel|kontakt", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|client", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|carte|karte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|\btel|call|fax|mobil|cell|t[eé]l[eé]f|ruf|llama", re.I),
}
_COUNTER = re.compile(r"version|\bv[0-9]|isbn|order|invoice|serial|page|token|sha|hash|\bid\b|\$|#|=\s*[\"']?$", re.I)
# top-level names, issuer digits, and area codes that exist
_TOP = frozenset("com org net edu gov info io de fr es uk eu it nl ch at be us ca co".split())


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _octets(span: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in span.split("."))


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, each kind leftmost and without overlap."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            found.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that overlap no base span of any kind."""
    taken = sorted((a, b) for _, a, b in base)
    found = []
    for kind, name in enumerate(KINDS):
        if name == "email" and "at" not in text or name == "ip" and ":" not in text:
            continue
        for m in _LOOSE[name].finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((kind, m.start(), m.end()))
    return found


def votes_and_features(text: str, kind: int, start: int, end: int, strict: bool) -> tuple[list[int], int]:
    """Votes of the labelers, and the classifier's features as bits."""
    span, name = text[start:end], KINDS[kind]
    before, digits = text[max(0, start - 32) : start], _digits(span)
    touching = (start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_.=")) or (
        end < len(text) and (text[end].isalnum() or text[end] in "_=")
    )
    known = checked = ABSTAIN
    if name == "email":
        top = re.split(r"[^A-Za-z0-9]+", span.rstrip(")]}> "))[-1].lower()
        known = FOR if top in _TOP else AGAINST
        usual = 5 <= len(span) <= 80
    elif name == "ip":
        checked = (FOR if _octets(span) else AGAINST) if "." in span else ABSTAIN
        known = AGAINST if span.startswith(("0.", "127.")) else ABSTAIN
        usual = 7 <= len(span) <= 39
    elif name == "card":
        checked = FOR if 13 <= len(digits) <= 19 and _luhn(digits) else AGAINST
        known = FOR if digits[:1] in {"3", "4", "5", "6"} else AGAINST
        usual = len(digits) in (15, 16)
    else:
        checked = FOR if 9 <= len(digits) <= 15 else AGAINST
        known = AGAINST if len(digits) == 10 and digits[0] in "01" else FOR
        usual = len(digits) in (10, 11, 12)
    near, counter = bool(_BEFORE[name].search(before)), bool(_COUNTER.search(before[-16:]))
    votes = [
        FOR if strict else AGAINST, checked, known, FOR if near else ABSTAIN, AGAINST if counter else ABSTAIN,
        AGAINST if touching else ABSTAIN,
    ]
    flags = (strict, checked == FOR, known == FOR, near, counter, touching, usual, any(c in span for c in " -.()"))
    return votes, sum(1 << i for i, f in enumerate(flags) if f)


def _found(texts: pa.Array) -> list[list[dict]]:
    """Base spans and candidates of each text, with votes and features."""
    some = pc.match_substring_regex(texts, r"[0-9@]|[\(\[\{<]at[\)\]\}>]").to_pylist()
    out = []
    for row, any_span in enumerate(some):
        found = []
        if any_span:
            text = texts[row].as_py()
            base = base_spans(text)
            for strict, spans in ((True, base), (False, loose_spans(text, base))):
                for kind, a, b in spans:
                    votes, features = votes_and_features(text, kind, a, b, strict)
                    code = sum((v + 1) * 3**i for i, v in enumerate(votes))
                    found.append({"kind": kind, "start": a, "stop": b, "base": strict, "votes": code,
                                  "features": features})
        out.append(found)
    return out


def _decided(spans: list[dict], table: dict) -> list[dict]:
    """Base spans and likely candidates, by kind and start."""
    kept = [s for s in spans if s["base"] or table.get((s["kind"], s["features"]), 0) >= ADDED]
    return sorted(kept, key=lambda s: (s["kind"], s["start"]))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
                       ("votes", pa.int32()), ("features", pa.int32())])
    for batch in slices(batches):
        out = _found(texts_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(kinds))], names=["id", "spans"])


_SPANS = "array<struct<kind: int, start: bigint, stop: bigint, base: boolean, votes: int, features: int>>"


def reliabilities(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How each labeler votes on both classes, and the probability of each vote pattern, by expectation-maximisation.

    The first result is (class, labeler, vote): shares of votes against, abstained and for. Labelers err
    independently; abstaining is a vote like others, as some speak up on one side only. The start, and pseudo-counts,
    hold that votes are right more often than not, which tells the two classes apart.
    """
    votes = codes[:, None] // 3 ** np.arange(LABELERS) % 3
    belief = np.array([[0.5, 0.35, 0.15], [0.15, 0.35, 0.5]])[:, None, :].repeat(LABELERS, axis=1)
    share, shares, p = 0.5, belief, np.full(len(codes), 0.5)
    for _ in range(200):
        both = [np.log(shares[k][np.arange(LABELERS), votes]).sum(1) for k in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(both[0] - both[1] + np.log((1 - share) / share), -500, 500)))
        moved, p = np.abs(new - p).max(initial=0), new
        share = float(((p * counts).sum() + 1) / (counts.sum() + 2))
        cast = [
            np.stack([((votes == v) * (w * counts)[:, None]).sum(0) for v in range(3)], axis=1) for w in (1 - p, p)
        ]
        shares = np.stack([(cast[k] + 8 * belief[k]) / (cast[k].sum(1, keepdims=True) + 8) for k in (0, 1)])
        if moved < 1e-9:
            break
    return shares, p


def span_classifier(features: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logistic weights of the feature bits and a constant, by Newton steps with a small ridge."""
    x = np.concatenate([features[:, None] >> np.arange(8) & 1, np.ones((len(features), 1))], axis=1).astype(np.float64)
    w = np.zeros(x.shape[1])
    scale = counts / max(counts.sum(), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (labels - p)) - 1e-3 * w
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(found: DataFrame) -> dict[tuple[int, int], float]:
    """Probability of personal data by (kind, feature bits); both tables are of a bounded number of rows."""
    counted = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.features").count().collect()
    table: dict[tuple[int, int], float] = {}
    for kind in range(len(KINDS)):
        rows = [r for r in counted if r["kind"] == kind]
        if not rows:
            continue
        counts = np.array([r["count"] for r in rows], np.float64)
        features = np.array([r["features"] for r in rows])
        _, labels = reliabilities(np.array([r["votes"] for r in rows]), counts)
        w = span_classifier(features, labels, counts)
        for f in np.unique(features).tolist():
            bits = np.append(f >> np.arange(8) & 1, 1)
            table[kind, f] = float(1 / (1 + np.exp(-bits @ w)))
    return table


def _candidates(work: Workspace, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {source.schema[0].dataType.simpleString()}, spans {_SPANS}"
    return work.keep(source.mapInArrow(_spans, schema), "spans")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and `spans`, an array of (kind, start, stop, base), by kind and start."""
    found = _candidates(Workspace(docs.sparkSession), docs, id_col, text_col)
    table = docs.sparkSession.sparkContext.broadcast(fit(found))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())])
        for batch in batches:
            rows = [
                [{"kind": KINDS[s["kind"]], "start": s["start"], "stop": s["stop"], "base": s["base"]}
                 for s in _decided(spans, table.value)]
                for spans in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kinds))], names=["id", "spans"])

    out = "array<struct<kind: string, start: bigint, stop: bigint, base: boolean>>"
    id_type = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(decide, f"id {id_type}, spans {out}").withColumnRenamed("id", id_col)


def masked(text: str, spans: list[dict]) -> str:
    """Text with each stretch covered by spans replaced by the kind of its first span, in angle brackets."""
    parts, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
        if s["start"] >= done:
            parts += [text[done : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
        done = max(done, s["stop"])
    return "".join([*parts, text[done:]])


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the spans of each text replaced by their kind; null texts and other columns unchanged.

    Spans are looked for twice, once to learn and once to replace: that is cheaper than to keep all texts twice.
    """
    work = Workspace(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(fit(_candidates(work, docs, id_col, text_col)))
    work.clear()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=at):
            old = batch.column(at).cast(pa.string())
            found = _found(texts_of(old))
            arrays = list(batch.columns)
            if any(found):
                arrays[at] = pa.array(
                    [masked(t.as_py(), _decided(f, table.value)) if f else t.as_py() for t, f in zip(old, found, strict=True)],
                    pa.string(),
                )
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of base spans of each kind, SHA-256 of the base spans, all spans as text."""

    def listed(spans):
        written = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        )
        return F.array_join(written, ",")

    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind))

    return find(docs, id_col, text_col).select(
        id_col,
        *(number(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
