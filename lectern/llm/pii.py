"""Personal data by weak supervision.

Candidate spans come from loose shapes of each kind; those of the base kinds are candidates too. Three labelers vote on each, for (1),
against (-1) or not at all (0): the strictness of its shape with its checksum, a gazetteer or numbering plan, and the words around it.
Expectation maximisation over the counted vote patterns estimates, for each kind, how reliable each labeler is, and with that how
likely each pattern is personal data. A logistic span classifier is trained on these posteriors, over votes and features of the span,
and decides: candidates that it accepts are added to the base spans, which always stay.

Only counts of patterns reach the driver: a pattern is a kind, three votes and four bucketed features, so there are ``MOST_PATTERNS``
at most, however many documents there are. Nothing about a document's spans leaves its task.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import map_rows, materialize, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban", "birth", "name")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Chains of numbers between dots; every four of them are a match. Starts inside a number are passed over at once.
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Common first names, mail hosts, IBAN lengths, and words around each kind that speak for and against it.
FIRST_NAMES = frozenset(
    "Adam Alexander Alice Ana Andrea Andreas Andrew Anna Anne Antoine Antonio Barbara Benjamin Brian Camille Carla Carlos Carmen Catherine Charles Charlotte Christian Christine Christopher Claire Claudia "
    "Daniel David Diego Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Eva Felix Fernando Francisco Frank Gabriel George Hannah Hans Heinz Helen Helga Henri Ingrid Isabel Jacques James Jan Jane Javier "
    "Jean Jennifer Jessica Joan Johann Johanna John Jonas Jorge Jose Joseph Juan Julia Julie Karen Karl Kevin Klaus Laura Lea Leon Linda Lisa Louis Lucas Lucia Luis Lukas Manuel Margaret Maria Marie Mario Mark "
    "Martin Mary Matthew Max Melissa Michael Michel Miguel Monika Nancy Nathalie Nicolas Nina Olivia Pablo Patricia Patrick Paul Pedro Peter Philippe Pierre Rafael Rebecca Richard Robert Rosa Ruth Sabine Samuel "
    "Sandra Sara Sarah Sergio Simon Sofia Sophie Stefan Stephen Steven Susan Thomas Ursula Victor Walter William Wolfgang".split()
)
MAIL_HOSTS = frozenset("gmail yahoo hotmail outlook gmx web icloud proton protonmail aol mail posteo orange free example".split())
IBAN_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "AT": 20, "CH": 21, "PT": 25, "PL": 28, "IE": 22, "SE": 24, "DK": 18, "NO": 15, "FI": 18}
CUES = {
    "email": (("mail", "contact", "write to", "reach", "kontakt", "correo", "courriel"), ("meet", "located")),
    "ip": (("ip", "address", "host", "server", "login", "from"), ("version", "release", "section", "v.")),
    "card": (("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"), ("isbn", "order", "invoice", "tracking")),
    "phone": (("phone", "call", "tel", "fax", "mobile", "telefon", "whatsapp", "reach", "llame", "appelez"), ("order", "invoice", "isbn", "item", "part no", "serial", "page", "model")),
    "ssn": (("ssn", "social", "security", "taxpayer"), ("order", "invoice", "isbn", "item", "part no", "serial", "page", "model", "phone")),
    "iban": (("iban", "account", "konto", "cuenta", "compte", "bank", "transfer"), ("serial", "model", "key", "code")),
    "birth": (("born", "birth", "dob", "geboren", "geburt", "nacid", "nacimiento", "né le", "née le", "naissance"), ("published", "updated", "version", "posted", "on sale", "due")),
    "name": (("name is", "dear", "signed", "hello", "patient", "llamo", "appelle", "heiße", "contact", "regards", "mr", "mrs", "dr"), ("street", "saint", "university", "prize", "avenue", "award")),
}
TITLED = re.compile(r"\b(?:M(?:rs?|s|me)|Dr|Herr|Frau|Sra?)\.? [A-Z][a-zà-ÿ]++(?: [A-Z][a-zà-ÿ]++)?")
INTRODUCED = re.compile(r"\b(?:[Mm]y name is|[Ii]ch heiße|[Mm]e llamo|[Jj]e m'appelle) [A-Z][a-zà-ÿ]++(?: [A-Z][a-zà-ÿ]++)?")
#: Loose shapes of each kind, in order, and the parts of which a text with a match has one (none: any text may have one). No shape
#: starts inside a run it could have started at.
LOOSE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]++)+"), ("at]", "at )", "at)", "at ]")),
    ("phone", re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9]|[-.][0-9])"), ()),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"), ("-",)),
    ("iban", re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"), ()),
    ("birth", re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9]|[./-][0-9])"), ("/", "-", ".19", ".20")),
    ("name", TITLED, ("Mr", "Ms", "Mme", "Dr", "Herr", "Frau", "Sr")),
    ("name", INTRODUCED, ("name is ", "heiße ", "llamo ", "appelle ")),
    ("name", re.compile(r"\b[A-Z][a-zà-ÿ]++ [A-Z][a-zà-ÿ]++"), ()),
)
LABELERS = ("shape", "gazetteer", "context")
#: kinds x base or not x 3 ** labelers x features (line start, length, digits, followed by a letter or digit).
MOST_PATTERNS = len(KINDS) * 2 * 27 * 2 * 4 * 4 * 2


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def dialled(digits: str) -> bool:
    """Whether ten digits keep to the North American plan: area and exchange codes start with 2 to 9 and are no N11; area codes have
    no 9 in the middle, and neither 37x nor 96x are given out."""
    area, exchange = digits[:3], digits[3:6]
    return area[0] > "1" and exchange[0] > "1" and "11" not in (area[1:], exchange[1:]) and area[1] != "9" and area[:2] not in ("37", "96")


def mod97(iban: str) -> bool:
    """The check digits of an account number without spaces."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start. Null and empty texts have none.

    Per kind, matches are leftmost and don't overlap; one that fails its test is dropped without another try in its text. Time grows
    with the text's length, whatever is in it.
    """
    if not text:
        return []
    out, after = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            out.append(("email", start, m.end()))
            after = m.end()
        at = text.find("@", max(after, at + 1))
    for m in DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(octet, four)):
                out.append(("ip", at, end))
            at = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def free_of(spans: list[tuple[str, int, int]]):
    """Whether (start, end) overlaps none of ``spans``, in logarithmic time."""
    merged: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]

    def free(start: int, end: int) -> bool:
        k = bisect_left(ends, start + 1)  # the first that ends behind the start
        return k == len(merged) or merged[k][0] >= end

    return free


def candidates(text: str | None, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """Base spans and looser ones that overlap none of them nor an earlier one of their kind, with their patterns."""
    if not text:
        return []
    found, free = [], free_of(base)
    for kind, shape, parts in LOOSE:
        if parts and not any(p in text for p in parts):
            continue
        new = [(kind, m.start(), m.end()) for m in shape.finditer(text) if free(m.start(), m.end())]
        if kind == "name":  # two capitalised words are a candidate only if the first is a first name
            apart = free_of([x for x in found if x[0] == kind])
            new = [x for x in new if apart(x[1], x[2]) and (shape in (TITLED, INTRODUCED) or text[x[1] : text.index(" ", x[1])] in FIRST_NAMES)]
        found += new
    return [(k, s, e, pattern(text, k, s, e, True)) for k, s, e in base] + [(k, s, e, pattern(text, k, s, e, False)) for k, s, e in found]


def shape_vote(kind: str, span: str, strict: bool) -> int:
    if strict:
        return 1
    if kind == "iban":
        return 1 if mod97(span.replace(" ", "")) else -1
    if kind == "birth":
        day = [int(x) for x in re.findall("[0-9]+", span)]
        return 0 if sorted(day)[0] >= 1 and sorted(day)[1] <= 31 and sorted(day)[0] <= 12 else -1
    if kind == "name":
        return 1 if TITLED.match(span) or INTRODUCED.match(span) else 0
    if kind == "phone":
        return 1 if span[0] == "(" else 0
    return 1 if kind == "email" else 0


def gazetteer_vote(kind: str, span: str, strict: bool) -> int:
    words = re.findall(r"[A-Za-zà-ÿ]+", span)
    if kind == "email":
        return 1 if any(w.lower() in MAIL_HOSTS for w in words[1:]) else 0
    if kind == "name":
        return 1 if any(w in FIRST_NAMES for w in words) else 0
    if kind == "phone" and not strict:
        return 1 if dialled(digits_of(span)) else -1
    if kind == "ssn":
        return -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1
    if kind == "iban":
        return 1 if IBAN_LENGTHS.get(span[:2]) == len(span.replace(" ", "")) else -1
    if kind == "birth":
        return 1 if 1920 <= max(int(x) for x in re.findall("[0-9]+", span)) <= 2012 else 0
    if kind == "card":
        return 1 if span[0] in "3456" else -1
    if kind == "ip":
        return -1 if span.split(".")[0].lstrip("0") in ("", "127", "255") else 0
    return 0


def context_vote(kind: str, text: str, s: int, e: int) -> int:
    """Words before the span and, for names, in it; the nearest forty characters."""
    near = text[max(0, s - 40) : e if kind == "name" else s].lower()
    good, bad = CUES[kind]
    found, against = max((near.rfind(w) for w in good), default=-1), max((near.rfind(w) for w in bad), default=-1)
    return 0 if found == against else 1 if found > against else -1


def pattern(text: str, kind: str, s: int, e: int, strict: bool) -> str:
    span = text[s:e]
    votes = shape_vote(kind, span, strict), gazetteer_vote(kind, span, strict), context_vote(kind, text, s, e)
    features = (int(s == 0 or text[s - 1] == "\n"), min(3, len(span) // 8), min(3, len(digits_of(span)) // 4), int(e < len(text) and text[e].isalnum()))
    return ":".join(map(str, (kind, int(strict), *votes, *features)))


#: What is believed before any data, and weighs like ``BELIEF`` spans: the share of votes for, among those cast by each labeler, if a
#: span is personal data and if not; and the share of candidates that are. Words that speak against a kind rarely stand before it.
BELIEVED = np.array([[0.9, 0.3], [0.8, 0.4], [0.95, 0.3]])
PRIOR, BELIEF = 0.3, 20


def estimate(votes: np.ndarray, strict: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the patterns of one kind, and the reliabilities (labeler, share of votes for in either class), by expectation
    maximisation. A labeler that doesn't vote says nothing. Base spans anchor the positive class."""
    told, prior, post = BELIEVED.copy(), PRIOR, np.zeros(len(votes))
    for _ in range(rounds):
        odds = np.full(len(votes), np.log(prior / (1 - prior)))
        odds += np.where(votes > 0, np.log(told[:, 0] / told[:, 1]), np.where(votes < 0, np.log((1 - told[:, 0]) / (1 - told[:, 1])), 0)).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        new = np.where(strict, np.maximum(0.9, new), new)
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
        share = np.stack([post, 1 - post]) * weight
        prior = (share[0].sum() + BELIEF * PRIOR) / (weight.sum() + BELIEF)
        told = ((share @ (votes > 0)).T + BELIEF * BELIEVED) / ((share @ (votes != 0)).T + BELIEF)
    return post, told


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * np.maximum(p * (1 - p), 1e-4))) @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(counts: dict[str, int]) -> set[str]:
    """Patterns that the trained span classifier accepts."""
    keys = sorted(counts)
    if not keys:
        return set()
    parts = [k.split(":") for k in keys]
    kind = np.array([KINDS.index(p[0]) for p in parts])
    strict = np.array([p[1] == "1" for p in parts])
    votes = np.array([[int(x) for x in p[2:5]] for p in parts])
    weight = np.array([counts[k] for k in keys], float)
    post = np.zeros(len(keys))
    for k in np.unique(kind):
        on = kind == k
        post[on], _ = estimate(votes[on], strict[on], weight[on])
    ones = np.ones((len(keys), 1))
    own = (kind[:, None] == np.arange(len(KINDS))).astype(float)
    features = np.array([[int(f) / 3 for f in p[5:]] for p in parts])
    # votes count for each kind on their own, and over all kinds where a kind has few spans
    x = np.concatenate([ones, own, votes, (own[:, :, None] * votes[:, None, :]).reshape(len(keys), -1), features], axis=1)
    balanced = 1000 * np.sqrt(weight) / np.sqrt(weight).sum()  # frequent patterns don't drown the rare ones
    w = fit_logistic(x, post, balanced, ridge=0.1)
    return {k for k, s in zip(keys, x @ w, strict=True) if s >= 0}


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


FOUND = "doc_id long, base array<struct<kind:string,start:int,end:int>>, extra array<struct<kind:string,start:int,end:int,pattern:string>>, patterns array<string>"


def label(docs: DataFrame) -> DataFrame:
    """Base spans, further candidates and the patterns of both, one row per document; written to the shared folder."""

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                base = base_spans(text)
                all_ = candidates(text, base)
                yield i, [dict(zip(("kind", "start", "end"), x, strict=True)) for x in base], [dict(zip(("kind", "start", "end", "pattern"), x, strict=True)) for x in all_[len(base) :]], [x[3] for x in all_]

        return rows

    return materialize(map_rows(docs.select("doc_id", "text"), FOUND, make))


def accepted_patterns(found: DataFrame) -> set[str]:
    counts = {r["p"]: r["count"] for r in found.select(F.explode("patterns").alias("p")).groupBy("p").count().toLocalIterator()}
    assert len(counts) <= MOST_PATTERNS  # by their make
    return learn(counts)


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) for every row of ``docs`` (doc_id, text); other columns are not read.

    Null and empty texts have no spans; long ones are searched whole. Rows with a null id and repeated rows each give their own; an
    empty table gives no rows.
    """
    found = label(docs)
    ok = sorted(accepted_patterns(found))
    keep = F.filter("extra", lambda c: c["pattern"].isin(ok)) if ok else F.filter("extra", lambda c: F.lit(False))
    bare = F.transform(keep, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("doc_id", F.concat("base", bare).alias("spans"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of :func:`detect`: counts and hash of the base kinds, and all spans as text."""
    found = label(table(spark, sf_dir, "documents"))
    ok = accepted_patterns(found)

    def make():
        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, base, extra in zip(*cols, strict=True):
                spans = [(x["kind"], x["start"], x["end"]) for x in base]
                more = [(x["kind"], x["start"], x["end"]) for x in extra if x["pattern"] in ok]
                yield (i, *(sum(x[0] == k for x in spans) for k in BASE), hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans + more))

        return rows

    return map_rows(found.select("doc_id", "base", "extra"), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make)
