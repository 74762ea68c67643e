"""Personal data by weak supervision.

Base spans (e-mail, IP, card, phone) are found by pattern and always stay. Every other token with
digits is a candidate, so is any token after the name of a secret or an assignment, and any name of
the gazetteer or after a title. Regex, gazetteer and context labelers vote on it; expectation-maximisation
over the counts of vote patterns in the whole corpus estimates how reliable each labeler is, and a
logistic classifier of the span's looks is trained on the resulting labels.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged, text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret", "name")

DIGIT = re.compile(r"[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """An address starts as far left of its @ as characters allow, after the one before it."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """All base spans, by kind as listed, then by start; positions in code points."""
    text = text or ""
    out = list(emails(text))
    if not DIGIT.search(text):
        return out
    for found in IP.finditer(text):
        if all(map(small_part, found.group().split("."))):
            out.append(("ip", found.start(), found.end()))
    for found in CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append(("card", found.start(), found.end()))
    for found in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, found.group())) <= 15:
            out.append(("phone", found.start(), found.end()))
    return out


TOKEN = re.compile(r"""[^\s"'<>()\[\]{},;|]+""")
NUMBER = re.compile(r"[0-9]+")
LEAST = 6  # characters of a candidate that only its digits make one
SEEN = 48  # characters of context before a candidate

LONG_CODE = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-fA-F]{12,}|[A-Za-z0-9+/_-]{16,}=*)$")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}$")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$")
PLAIN = re.compile(r"[v$€£#~(]*[0-9]{1,4}(?:[.:/x-][0-9]{1,4})*[.:!?)%$€£]*$")
SECRET_WORDS = (
    r"token|passw(?:or)?d|passwort|secret|api[_-]?key|access[_-]?key|private[_-]?key|credential|"
    r"contraseña|mot de passe|ssn|social security|iban|passport|konto|account"
)
SECRETS = re.compile(rf"(?:{SECRET_WORDS})\W*$", re.IGNORECASE)
HARMLESS = re.compile(
    r"(?:page|seite|página|version|chapter|kapitel|capítulo|chapitre|figure|table|section|vol|no|nr|isbn|"
    r"rfc|year|jahr|año|année)\W*$",
    re.IGNORECASE,
)
ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
# what stands before a token of any characters: all of a secret's name, or an assignment but no URL
NAMED = re.compile(rf"(?:{SECRET_WORDS})(?!\w)\W*", re.IGNORECASE)
ASSIGNS = re.compile(r"[=:](?!//)\s*[\"']?")
STEMS = "token pass secret key cred contrase mot ssn social iban konto account".split()  # one is in each of the words

TITLES = "Mr Mrs Ms Miss Dr Prof Professor Sir Herr Frau Señor Señora Don Doña Monsieur Madame Mme Mlle".split()
GIVEN_NAMES = """
    James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Donald
    Steven Andrew Paul Joshua Kenneth Kevin Brian George Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas
    Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick Jack Dennis Jerry Peter
    Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Sandra Margaret Ashley
    Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Laura Helen Sharon Cynthia Kathleen
    Amy Angela Anna Ruth Brenda Pamela Nicole Katherine Samantha Christine Emma Catherine Virginia Rachel Janet Maria
    Heather Diane Julie Joyce Victoria Kelly Christina Joan Evelyn Olivia Sophia Isabella Charlotte Alice Bob Eve
    Hans Peter Wolfgang Klaus Jürgen Dieter Manfred Uwe Günter Horst Bernd Helmut Heinz Stefan Andreas Matthias Lukas
    Felix Jonas Maximilian Ursula Monika Petra Sabine Renate Gisela Ingrid Brigitte Heike Birgit Katrin Anja Lena Lea
    José Juan Antonio Francisco Manuel Javier Carlos Jesús Miguel Ángel Rafael Pedro Pablo Sergio Fernando Jorge Luis
    Alberto Álvaro Diego Alejandro Carmen Josefa Isabel Dolores Pilar Teresa Lucía Marta Elena Cristina Rosa Sofía Ana
    Jean Pierre Michel André Philippe Alain Jacques Bernard Marcel Daniel Roger Claude Louis François Henri Nicolas
    Julien Antoine Marie Jeanne Françoise Monique Nathalie Isabelle Jacqueline Sylvie Martine Chloé Camille Léa Manon
""".split()
CAPITALISED = r"[A-ZÀ-ÖØ-Þ][^\W\d_]+"
WORD = re.compile(rf"{CAPITALISED}\b")
SURNAME = re.compile(rf"(?:[ -]{CAPITALISED}\b)?")
AFTER_TITLE = re.compile(rf"\.?[ ]+({CAPITALISED}\b(?:[ -]{CAPITALISED}\b)?)")
TITLED = re.compile(rf"\b(?:{'|'.join(TITLES)})\.?\s+$")
KNOWN = frozenset(GIVEN_NAMES)


def known_name(token: str) -> bool:
    return not KNOWN.isdisjoint(re.split(r"[ -]", token))


def iban(token: str) -> bool:
    if not IBAN.match(token):
        return False
    turned = token[4:] + token[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


# Labelers: for a token and the text before it, 2 for personal, 1 for harmless, 0 for no vote.
LABELERS = (
    lambda token, before: 2 if LONG_CODE.match(token) or SSN.match(token) or iban(token) else 0,  # regex
    lambda token, before: 1 if PLAIN.match(token) else 0,  # regex
    lambda token, before: 2 if known_name(token) else 0,  # gazetteer
    lambda token, before: 2 if SECRETS.search(before) or TITLED.search(before) else 1 if HARMLESS.search(before) else 0,  # context
    lambda token, before: 2 if ASSIGNED.search(before) else 0,  # context
    lambda token, before: 2 if len(set(token)) >= 9 else 1 if len(set(token)) <= 5 else 0,  # context-free look
)
FEATURES = (
    lambda token, before: len(token) >= 10,
    lambda token, before: len(token) >= 16,
    lambda token, before: sum(map(str.isdigit, token)) * 4 >= len(token),
    lambda token, before: any(c.isalpha() for c in token),
    lambda token, before: len(NUMBER.findall(token)) >= 3,
    lambda token, before: bool(SECRETS.search(before)),
    lambda token, before: bool(ASSIGNED.search(before)),
    lambda token, before: bool(SSN.match(token)) or iban(token),
    lambda token, before: known_name(token) or bool(TITLED.search(before)),
    lambda token, before: token.isalpha(),
)
VOTES = 3 ** len(LABELERS)
SIGNATURES = VOTES << len(FEATURES)  # 746 496: bounds what is counted and sent to tasks


def signature(token: str, before: str) -> int:
    """The votes of all labelers and the features, as one number below `SIGNATURES`."""
    votes = 0
    for label in LABELERS:
        votes = 3 * votes + label(token, before)
    for feature in FEATURES:
        votes = 2 * votes + feature(token, before)
    return votes


def numbered(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of tokens of `LEAST` characters with digits; a token ends where a base span begins."""
    reach = list(accumulate((b for _, b in taken), max))
    end = 0
    for found in NUMBER.finditer(text):
        start = found.start()
        k = bisect_left(taken, (start + 1,))  # spans that start no later
        behind = max(end, reach[k - 1] if k else 0)
        if behind >= found.end():
            continue
        start = digit = max(start, behind)
        while start > behind and TOKEN.match(text[start - 1]):
            start -= 1
        end = TOKEN.match(text, digit, taken[k][0] if k < len(taken) else len(text)).end()
        split = max(text.rfind("=", start, digit), text.rfind(":", start, digit)) + 1
        first = max(start, split)
        last = first + len(text[first:end].rstrip(".:!?="))
        if last - first >= LEAST:
            yield first, last


def persons(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of capitalised names after a title, and of given names with a surname, if any."""
    end = 0
    for word in WORD.finditer(text):
        start = word.start()
        if start < end or start and (text[start - 1].isalnum() or text[start - 1] == "_"):
            continue
        if word.group() in KNOWN:
            end = SURNAME.match(text, word.end()).end()
            yield start, end
        elif word.group() in TITLES and (named := AFTER_TITLE.match(text, word.end())):
            end = named.end()
            yield named.span(1)


def in_context(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, is a name) of tokens after a secret's name or an assignment, and of persons' names."""
    folded = text.casefold()
    for pattern in (NAMED, ASSIGNS) if any(stem in folded for stem in STEMS) else (ASSIGNS,):
        for found in pattern.finditer(text):
            if token := TOKEN.match(text, found.end()):
                yield found.end(), found.end() + len(token.group().rstrip(".:!?=")), False
    for start, end in persons(text):
        yield start, end, True


def candidates(text: str | None, base: list[Span]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, signature) of all candidates; they overlap no base span nor each other."""
    text = text or ""
    taken = sorted((a, b) for _, a, b in base)
    tokens = [(first, last, False) for first, last in numbered(text, taken)]
    taken = sorted(taken + [(a, b) for a, b, _ in tokens])
    reach = list(accumulate((b for _, b in taken), max))
    end = 0
    for first, last, name in sorted(in_context(text), key=lambda t: (t[0], -t[1])):
        before = bisect_left(taken, (last,))  # spans that start before the token ends
        if first < max(end, reach[before - 1] if before else 0) or first == last:
            continue
        tokens.append((first, last, name))
        end = last
    out = []
    for first, last, name in sorted(tokens):
        token, before = text[first:last], text[max(0, first - SEEN) : first]
        kind = "name" if name else "iban" if iban(token) else "ssn" if SSN.match(token) else "secret"
        out.append((kind, first, last, signature(token, before)))
    return out


def reliabilities(counts: dict[int, int], rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vote patterns, their probability of being personal, labelers' vote rates by class).

    Expectation-maximisation for independent labelers. Rates start from, and are drawn to by ten
    imagined candidates, labelers that vote rightly four times as often as wrongly.
    """
    patterns = np.array(sorted({s >> len(FEATURES) for s in counts}), np.int64)
    weight = np.zeros(len(patterns))
    for s, n in counts.items():
        weight[np.searchsorted(patterns, s >> len(FEATURES))] += n
    votes = np.stack([patterns // 3**k % 3 for k in reversed(range(len(LABELERS)))], axis=1)
    prior = np.array([[0.3, 0.56, 0.14], [0.3, 0.14, 0.56]])  # by class: no vote, harmless, personal
    rates = np.repeat(prior[:, None, :], len(LABELERS), axis=1)
    share = 0.5
    for _ in range(rounds):
        logs = [sum(np.log(rates[c, k][votes[:, k]]) for k in range(len(LABELERS))) for c in (0, 1)]
        odds = np.clip(logs[1] - logs[0] + np.log(share / (1 - share)), -30, 30)
        personal = 1 / (1 + np.exp(-odds))
        share = float(np.clip((weight @ personal + 5) / (weight.sum() + 10), 0.02, 0.98))
        for c, part in enumerate((weight * (1 - personal), weight * personal)):
            for k in range(len(LABELERS)):
                seen = np.bincount(votes[:, k], part, minlength=3) + 10 * prior[c]
                rates[c, k] = seen / seen.sum()
    return patterns, personal, rates


def classifier(counts: dict[int, int], rounds: int = 500) -> np.ndarray:
    """For each signature, whether the trained classifier takes the span as personal.

    A logistic model of the features, fitted to the estimated probabilities of all candidates.
    """
    personal = np.zeros(SIGNATURES, bool)
    if not counts:
        return personal
    patterns, odds, _ = reliabilities(counts)
    signatures = np.array(sorted(counts), np.int64)
    weight = np.array([counts[s] for s in signatures.tolist()], np.float64)
    weight /= weight.sum()
    target = odds[np.searchsorted(patterns, signatures >> len(FEATURES))]
    bits = [signatures >> k & 1 for k in range(len(FEATURES))]
    x = np.stack([np.ones(len(signatures)), *bits], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps with a little shrinkage converge long before
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-4 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    every = np.arange(1 << len(FEATURES))
    looks = np.stack([np.ones(len(every)), *[every >> k & 1 for k in range(len(FEATURES))]], axis=1) @ w
    return np.tile(looks >= 0, VOTES)


SPANS = "array<struct<kind: string, start: int, stop: int, signature: int>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("signature", pa.int32())])
)


def _find(batches: Iterable[pa.RecordBatch], text: int, out: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch.column(text)):
            part, rows = batch.slice(a, b - a), []
            for t in part.column(text).to_pylist():
                base = base_spans(t)
                rows.append([(*s, -1) for s in base] + candidates(t, base))
            columns = dict(zip(part.schema.names, part.columns))
            spans = [[dict(zip(("kind", "start", "stop", "signature"), s)) for s in row] for row in rows]
            yield pa.RecordBatch.from_pydict({**columns, out: pa.array(spans, SPAN_TYPE)})


def find(docs: DataFrame, out: str = "spans") -> DataFrame:
    """`docs` with `out`: base spans (signature -1) and candidates with their signatures."""
    docs = docs.drop(out)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    work = partial(_find, text=docs.columns.index("text"), out=out)
    return docs.mapInArrow(work, ", ".join([*fields, f"`{out}` {SPANS}"]))


def train(spans: DataFrame) -> np.ndarray:
    """The classifier for the candidates of a whole corpus, from their counts by signature.

    `spans` has one column, what `find` adds.
    """
    each = spans.toDF("spans").select(F.explode("spans.signature").alias("s")).where("s >= 0")
    # at most SIGNATURES rows
    return classifier({r["s"]: r["count"] for r in each.groupBy("s").count().collect()})


def accepted(spans: list[dict], personal: np.ndarray) -> list[Span]:
    """Base spans and accepted candidates, by kind as listed, then by start."""
    kept = [(s["kind"], s["start"], s["stop"]) for s in spans or () if s["signature"] < 0 or personal[s["signature"]]]
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, start, stop in spans)


REPORT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def _report(batches: Iterable[pa.RecordBatch], personal: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [accepted(spans, personal) for spans in batch.column(1).to_pylist()]
        counts = [[sum(s[0] == kind for s in row) for row in rows] for kind in BASE_KINDS]
        base = [joined(s for s in row if s[0] in BASE_KINDS) for row in rows]
        digests = [hashlib.sha256(text.encode()).hexdigest() for text in base]
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts)]
        texts = [pa.array(x, pa.string()) for x in (digests, [joined(row) for row in rows])]
        names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([*columns, *texts], names)


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of base spans, their digest, and all spans as text.

    Whole texts are searched; null and empty texts hold nothing. Rows that repeat are reported as
    often as they come; an empty table gives an empty result.
    """
    found = staged(find(docs.select("doc_id", "text")).select("doc_id", "spans"), "spans")
    return found.mapInArrow(partial(_report, personal=train(found.select("spans"))), REPORT)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def _redact(batches: Iterable[pa.RecordBatch], personal: np.ndarray, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [accepted(s, personal) for s in batch.column(batch.num_columns - 1).to_pylist()]
        texts = [redacted(t, s) for t, s in zip(batch.column(text).to_pylist(), spans)]
        columns = dict(zip(batch.schema.names[:-1], batch.columns[:-1]))
        columns[batch.schema.names[text]] = pa.array(texts, batch.schema.field(text).type)
        yield pa.RecordBatch.from_pydict(columns)


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` replaced by its kind; all rows and other columns stay."""
    found = staged(find(docs, "__spans__"), "spans")
    personal = train(found.select("__spans__"))
    work = partial(_redact, personal=personal, text=docs.columns.index("text"))
    return found.mapInArrow(work, docs.schema)
