"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides on spans.

Base spans (email, ip, card, phone) follow fixed patterns and always stay.
Candidates for more spans are looser forms of the same kinds (a card or phone
whose pattern ran into a neighbouring number among them), ids of persons,
secrets (long runs of letters and digits, as keys and tokens are) and names
after a title. Three labelers vote on every candidate: a regex labeler (is the
form strict, are its check digits right, are its characters as mixed as those of
a key), a gazetteer labeler (known endings, prefixes, issuers, first names; its
lists are a parameter) and a context labeler (words before the span that
announce or exclude such data). A vote is yes, no or none.

Votes fall into a bounded number of (kind, votes, features) patterns, counted in
Spark over all documents. Expectation-maximisation on the pattern counts
estimates each labeler's reliability and each pattern's chance of being personal
data, without any labels; a logistic classifier of spans is trained on the
patterns with these chances as soft targets, each weighed by its share of all
candidates, so the fit is the same for the same mix at every size. A candidate
that it gives at least `threshold` becomes a span if it overlaps no base span or earlier span.

Defined cases: null or empty text has no spans; spans are in code points, end
exclusive; of overlapping candidates the first one stays, of those of one start
the longest; texts of any length are scanned whole, in linear time whatever they
hold; repeated rows have equal results; without candidates no classifier is
trained and only base spans remain; an empty table gives an empty result; other
columns are ignored, and kept as they are by redact().
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, importable, store
from .text import slices

BASE_KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a run of digits that fails from its start fails from every later digit too, so a match never starts inside one
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, but from each @ outwards: the run before it is walked once."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in LOCAL_CHARS:
                start -= 1
            match = DOMAIN.match(text, at + 1) if start < at else None
            if match:
                yield start, match.end()
                done = match.end()
            else:
                done = max(done, at)
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# Forms of candidates, words that announce them and words that exclude them.
CANDIDATES = {
    "email": re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]++)++"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])|(?<![0-9])00[0-9]{1,3} [0-9]{2,4}(?: [0-9]{2,4}){1,4}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{13})(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+=*+"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Mme|Señor|Señora|Sra|Sr)\.? (?=[^\W\d_])"),
}
WORD = re.compile(r"[^\W\d_]++")
TRIGGERS = {
    "email": ("[at]", "(at)"),
    "phone": ("-", ".", " ", "(", "00"),
    "card": (),
    "ssn": ("-",),
    "iban": (),
    "secret": (),
    "name": ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mada", "Monsieur", "Mme", "Señor", "Sra", "Sr"),
}
ANNOUNCE = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"),
    "card": ("card", "visa", "master", "credit", "karte", "tarjeta", "carte"),
    "ssn": ("ssn", "social security", "sozialversicherung", "seguridad social", "sécurité sociale"),
    "iban": ("iban", "account", "konto", "cuenta", "compte", "bank"),
    "secret": ("token", "secret", "passw", "key", "auth", "credential", "bearer"),
    "name": ("name", "dear", "signed", "by", "sehr geehrte", "querido", "cher", "nombre", "nom"),
}
EXCLUDE = ("version", "isbn", "issn", "doi", "part no", "serial", "page", "error", "http", "example", "chapter", "sha1", "sha256", "md5", "commit", "checksum")
FIRST_NAMES = frozenset("james john robert michael william david maria mary patricia linda anna peter thomas hans klaus ursula petra jean pierre marie claire sophie jose juan carlos carmen ana luis laura elena paul martin sarah".split())
ISSUERS = frozenset("34 35 37 51 52 53 54 55 62 65".split())
FIRST_TWO = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
KEY_PREFIXES = ("AKIA", "AIza", "ghp_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-", "eyJ")


@dataclass(frozen=True)
class Gazetteer:
    """The lists of the gazetteer labeler; larger ones than these come from a caller's own data."""

    first_names: frozenset[str] = FIRST_NAMES
    issuers: frozenset[str] = ISSUERS
    countries: frozenset[str] = FIRST_TWO
    key_prefixes: tuple[str, ...] = KEY_PREFIXES


def mixed(run: str) -> bool:
    """Whether letters and digits alternate as often as in a random key: at least an eighth of all steps, two in all for each class."""
    kinds = "".join("d" if c.isdigit() else "a" for c in run if c.isalnum())
    return 8 * sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) >= max(len(kinds) - 1, 24)


@dataclass
class Candidate:
    kind: str
    start: int
    end: int
    votes: tuple[int, int, int]  # regex, gazetteer, context: 1 yes, -1 no, 0 none
    features: tuple[int, int]  # digits in fours, upper-case initial

    def pattern(self) -> str:
        return f"{self.kind}|{self.votes[0]},{self.votes[1]},{self.votes[2]}|{self.features[0]},{self.features[1]}"


def iban_ok(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def vote(kind: str, text: str, start: int, end: int, known: Gazetteer) -> Candidate:
    span, before = text[start:end], text[max(0, start - 40) : start].lower()
    digits = re.sub(r"[^0-9]", "", span)
    strict = gazetteer = 0
    if kind == "email":
        strict = 1 if "dot" in span else -1
        gazetteer = 1 if re.search(r"(com|org|net|edu|de|fr|es|info|io)\Z", span) else 0
    elif kind == "phone":
        strict = 1 if len(set(digits)) > 2 and digits[:1] not in ("1",) else -1
        gazetteer = 1 if span[:1] == "(" or digits.startswith("00") else 0
    elif kind == "card":
        strict = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[:1] == "4" or digits[:2] in known.issuers else -1
    elif kind == "ssn":
        strict = 1 if digits[:3] not in ("000", "666") and digits[:1] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1
    elif kind == "iban":
        strict = 1 if iban_ok(span.replace(" ", "")) else -1
        gazetteer = 1 if span[:2] in known.countries else -1
    elif kind == "secret":
        strict = 1 if mixed(span) else -1
        gazetteer = 1 if span.startswith(known.key_prefixes) else 0
    elif kind == "name":
        strict = 1 if all(w[:1].isupper() for w in span.split()) else -1
        gazetteer = 1 if any(w.lower() in known.first_names for w in span.split()) else 0
    context = 1 if any(w in before for w in ANNOUNCE[kind]) else -1 if any(w in before for w in EXCLUDE) else 0
    return Candidate(kind, start, end, (strict, gazetteer, context), (min(len(digits) // 4, 4), int(span[:1].isupper())))


def names_after(title: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """The word after a title and the capitalised ones that follow it."""
    found = title.search(text)
    while found:
        start = found.end()
        end = WORD.match(text, start).end()
        while text[end : end + 1] == " " and (word := WORD.match(text, end + 1)) and word.group()[0].isupper():
            end = word.end()
        yield start, end
        found = title.search(text, end)


def candidates(text: str, base: list[tuple[str, int, int]], known: Gazetteer = Gazetteer()) -> list[Candidate]:  # noqa: B008
    """Loose matches outside the base spans, in order, none overlapping another."""
    taken = sorted((a, b) for _, a, b in base)
    digits = re.search(r"[0-9]{2}", text) is not None
    found: list[Candidate] = []
    for kind, pattern in CANDIDATES.items():
        if kind in ("phone", "card", "ssn", "iban", "secret") and not digits or TRIGGERS[kind] and not any(t in text for t in TRIGGERS[kind]):
            continue
        for a, b in names_after(pattern, text) if kind == "name" else (m.span() for m in pattern.finditer(text)):
            found.append(vote(kind, text, a, b, known))
    found.sort(key=lambda c: (c.start, -c.end, c.kind))
    kept: list[Candidate] = []
    for c in found:
        i = bisect_left(taken, (c.start, c.start))
        clear = (i == len(taken) or taken[i][0] >= c.end) and (i == 0 or taken[i - 1][1] <= c.start)
        if clear and (not kept or kept[-1].end <= c.start):
            kept.append(c)
    return kept


@dataclass
class SpanModel:
    """Reliabilities of the labelers and the weights of the span classifier."""

    kinds: list[str] = field(default_factory=list)
    reliabilities: dict[str, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    chances: dict[str, float] = field(default_factory=dict)

    def row(self, pattern: str) -> np.ndarray:
        kind, votes, features = pattern.split("|")
        v, f = [int(x) for x in votes.split(",")], [int(x) for x in features.split(",")]
        return np.array([1.0, *(float(kind == k) for k in self.kinds), *(float(x == 1) for x in v), *(float(x == -1) for x in v), f[0] / 4, f[1]])

    def chance(self, pattern: str) -> float:
        if not len(self.weights) or pattern.split("|")[0] not in self.kinds:
            return 0.0
        if pattern not in self.chances:
            self.chances[pattern] = float(1 / (1 + np.exp(-self.row(pattern) @ self.weights)))
        return self.chances[pattern]


def fitted(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic weights for soft targets y of rows weighed by n: Newton steps, halved while they lose, until none gains."""

    def loss(w: np.ndarray) -> float:
        return float(n @ (np.logaddexp(0, x @ w) - y * (x @ w)) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (n * (y - p)) - ridge * w)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-10:
            step = step / 2
        w = w + step
        if np.abs(step).max() <= 1e-10:
            break
    return w


def learn(counts: dict[str, int], rounds: int = 50, ridge: float = 1e-6) -> SpanModel:
    """EM over vote patterns for each kind, then the classifier on soft targets."""
    model = SpanModel(kinds=sorted({p.split("|")[0] for p in counts}))
    soft: dict[str, float] = {}
    for kind in model.kinds:
        names = sorted(p for p in counts if p.split("|")[0] == kind)
        n = np.array([counts[p] for p in names], float)
        votes = np.array([[int(x) for x in p.split("|")[1].split(",")] for p in names])
        # rows: personal or not; columns: none, yes, no. Labelers start out better than chance.
        rates = np.tile(np.array([[0.3, 0.55, 0.15], [0.45, 0.1, 0.45]]), (3, 1, 1))
        prior = 0.5
        for _ in range(rounds):
            chance = np.stack([np.log(prior) + sum(np.log(rates[j, 0, votes[:, j]]) for j in range(3)), np.log(1 - prior) + sum(np.log(rates[j, 1, votes[:, j]]) for j in range(3))])
            chance = np.exp(chance - chance.max(0))
            chance /= chance.sum(0)
            prior = float(np.clip((n * chance[0]).sum() / n.sum(), 0.02, 0.98))
            for j in range(3):
                for c in range(2):
                    weight = np.array([(n * chance[c])[votes[:, j] == v].sum() for v in (0, 1, -1)])
                    start = np.array([[0.3, 0.55, 0.15], [0.45, 0.1, 0.45]])[c]
                    rates[j, c] = (weight + 2 * start) / (weight.sum() + 2)
        model.reliabilities[kind] = rates
        soft |= dict(zip(names, chance[0], strict=True))
    if soft:
        names = sorted(soft)
        x, y = np.stack([model.row(p) for p in names]), np.array([soft[p] for p in names])
        n = np.array([counts[p] for p in names], float)
        model.weights = fitted(x, y, n / n.sum(), ridge)
    return model


CANDIDATE_TYPE = pa.list_(pa.struct([("pattern", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
BASE_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: Gazetteer = Gazetteer()) -> DataFrame:  # noqa: B008
    """(doc_id, base, candidates): the one pass over the texts."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 22)):
            base, more = [], []
            for value in batch.column("text"):
                whole = value.as_py() or ""
                spans = base_spans(whole)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                more.append([{"pattern": c.pattern(), "start": c.start, "end": c.end} for c in candidates(whole, spans, known)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, BASE_TYPE), pa.array(more, CANDIDATE_TYPE)], ["doc_id", "base", "candidates"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(run, f"doc_id {kind}, base array<struct<kind:string,start:bigint,end:bigint>>, candidates array<struct<pattern:string,start:bigint,end:bigint>>")


def fit(scanned: DataFrame) -> SpanModel:
    """Counts of patterns over all documents; there are at most a few hundred patterns."""
    counts = scanned.select(F.explode("candidates.pattern").alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return learn({r["pattern"]: r["n"] for r in counts.collect()})


def decide(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]], model: SpanModel, threshold: float) -> list[tuple[str, int, int]]:
    added = [(p.split("|")[0], a, b) for p, a, b in more if model.chance(p) >= threshold]
    order = {k: i for i, k in enumerate(BASE_KINDS)}
    return sorted([*base, *added], key=lambda s: (order.get(s[0], len(order)), s[0] if s[0] not in order else "", s[1]))


def find(docs: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text", known: Gazetteer = Gazetteer()) -> DataFrame:  # noqa: B008
    """(doc_id, base, spans): base and all spans as arrays of (kind, start, end)."""
    scanned = store(scan(docs, doc_id, text, known), "scanned")
    shared = docs.sparkSession.sparkContext.broadcast(fit(scanned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                spans = decide([(x["kind"], x["start"], x["end"]) for x in base], [(x["pattern"], x["start"], x["end"]) for x in more], shared.value, threshold)
                out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("base"), pa.array(out, BASE_TYPE)], ["doc_id", "base", "spans"])

    kind = dict(scanned.dtypes)["doc_id"]
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return scanned.mapInArrow(run, f"doc_id {kind}, base {span}, spans {span}")


def joined(spans: str) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text", known: Gazetteer = Gazetteer()) -> DataFrame:  # noqa: B008
    """The rows, all columns, with each span of the text replaced by its kind in angle brackets.

    Texts are scanned twice: the first scan is for the votes alone, since keeping
    its spans beside the rows would write all texts once more.
    """
    scanned = store(scan(docs, doc_id, text, known), "scanned")
    model = docs.sparkSession.sparkContext.broadcast(fit(scanned))
    forget(scanned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text, 1 << 22)):
            at = batch.schema.get_field_index(text)
            out = [None if v.as_py() is None else replaced(v.as_py(), model.value, threshold, known) for v in batch.column(text)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, model: SpanModel, threshold: float, known: Gazetteer = Gazetteer()) -> str:  # noqa: B008
    base = base_spans(text)
    spans = sorted((a, b, k) for k, a, b in decide(base, [(c.pattern(), c.start, c.end) for c in candidates(text, base, known)], model, threshold))
    out, done = [], 0
    for a, b, k in spans:
        if a >= done:
            out += [text[done:a], f"<{k.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def digest(column: str) -> F.Column:
    return F.sha2(joined(column), 256)


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
