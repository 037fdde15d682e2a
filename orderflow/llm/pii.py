"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidate spans. Six labelers (shape, validity, a gazetteer, words of context,
clean borders, variety of characters) vote yes, no or nothing on each. The votes of all documents
are counted by kind and pattern of votes (at most KINDS * 3 ** 6 rows, whatever the data);
expectation-maximisation over these counts estimates how reliable each labeler is, and a logistic
classifier of kind and votes is trained on the resulting probabilities.

Valid e-mail addresses, IP addresses, card and phone numbers are base spans and always reported. The
classifier decides on the candidates of the added kinds (secrets, social security numbers, IBANs).

Null and empty texts have no spans. Spans are half-open intervals of code points. Ids may be null or
repeated: each row is handled on its own. Extra columns pass through where kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.common import free_name

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "ssn", "iban")
KINDS = BASE + ADDED
LABELERS = ("shape", "valid", "gazetteer", "context", "border", "variety")
CONTEXT_CHARS = 48
CUTOFF = 0.5
EM_ROUNDS = 60
FIT_ROUNDS = 400

# A candidate can only begin where a run of its characters begins (or where the last match ended),
# which keeps the search linear; nothing is ever given back, hence the possessive quantifiers.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{24,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
}
# What a text must contain for a search to be worth while.
_HINTS = {"email": "@", "phone": "+", "ssn": "-"}

# Gazetteers and cue words.
_TOP_LEVEL = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|it|nl|ch|at|be|us|ca"
_KEY_NAMES = "token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|bearer|auth"
_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE"
_CUES = {
    "email": r"mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse|login",
    "card": r"card|visa|master|payment|karte|tarjeta|carte",
    "phone": r"phone|\btel|call|mobile|fax|telefon",
    "secret": rf"({_KEY_NAMES})",
    "ssn": r"ssn|social|security",
    "iban": r"iban|account|bank|konto|cuenta|compte",
}
_OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value) in code points."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit([]).cast("array<struct<start:int,end:int,value:string>>").alias("spans"),
    )

    def add(done: Column, item: Column) -> Column:
        begin = done["at"] + F.char_length(item["gap"])
        end = begin + F.char_length(item["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), item["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    items = F.zip_with(gaps, values, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(items, start, add, lambda done: done["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_valid(kind: str, value: Column) -> Column:
    """The checks beyond the pattern."""
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """``+`` for yes, ``-`` for no, ``0`` for abstaining; unsaid, what is not yes is no."""
    if no is None:
        return F.when(yes, "+").otherwise("-")
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _votes(kind: str, text: Column, span: Column) -> Column:
    value, start, end = span["value"], span["start"], span["end"]
    size = F.char_length(value)
    before = F.substring(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS)))
    left, right = F.right(before, F.lit(1)), F.substring(text, end + 1, F.lit(1))
    strict = {
        "email": value.rlike(r"^[A-Za-z0-9][^@]{0,63}@[A-Za-z0-9.-]{3,}$"),
        "ip": value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"),
        "card": value.rlike(r"^[0-9]{13,19}$|^[0-9]{4}([ -][0-9]{4}){3}$"),
        "phone": value.rlike(r"^\+[0-9]{1,3} ?\(?[0-9]"),
        "secret": value.rlike(r"^([0-9a-f]{24,}|[0-9A-F]{24,})$"),
    }.get(kind, size >= 9)
    listed = {
        "email": _vote(value.rlike(rf"(?i)\.({_TOP_LEVEL})$"), F.lit(False)),
        "ip": _vote(F.lit(False), value.rlike(r"^(0|127|255)\.")),
        "card": _vote(value.rlike("^(3[47]|4|5[1-5]|6)"), F.lit(False)),
        "phone": _vote(value.rlike(r"^\+(1|3[0-9]|4[0-9]|6[0-6]|7|8[1-6]|9[0-8])"), F.lit(False)),
        "secret": _vote(F.lower(before).rlike(rf"({_KEY_NAMES})\W{{0,4}}$"), F.lit(False)),
        "ssn": F.lit("0"),
        "iban": _vote(value.rlike(f"^({_COUNTRIES})")),
    }[kind]
    cue = _vote(F.lower(before).rlike(_CUES[kind]), F.lit(False))
    border = _vote(~left.rlike(r"[\p{L}\p{N}]") & ~right.rlike(r"[\p{L}\p{N}]"))
    kinds_of = F.size(F.array_distinct(F.split(value, "")))
    variety = _vote(kinds_of >= 5, kinds_of <= 2)
    return F.concat(_vote(strict), _vote(is_valid(kind, value)), listed, cue, border, variety)


def _describe(kind: str, text: Column) -> Callable[[Column], Column]:
    return lambda span: F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.coalesce(is_valid(kind, span["value"]), F.lit(False)).alias("valid"),
        _votes(kind, text, span).alias("votes"),
    )


def candidates(text: Column) -> Column:
    """All candidate spans in the order of KINDS, then start: (kind, start, end, valid, votes)."""
    found = []
    has_digit = text.rlike("[0-9]")
    nothing = F.lit([]).cast(
        "array<struct<kind:string,start:int,end:int,valid:boolean,votes:string>>"
    )
    for kind in KINDS:
        hint = text.contains(_HINTS[kind]) if kind in _HINTS else F.lit(True)
        worth = hint if kind == "email" else has_digit & hint

        spans = F.transform(find_all(text, PATTERNS[kind]), _describe(kind, text))
        found.append(F.when(worth, spans).otherwise(nothing))
    return F.concat(*found)


def propose(
    docs: DataFrame, keep: Iterable[str], text_col: str = "text"
) -> tuple[DataFrame, str]:
    """``keep`` and the candidate spans of every document; the frame and their column's name."""
    keep = list(keep)
    name = free_name(docs.select(*keep), "candidates")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(*keep, candidates(text).alias(name)), name


def count_votes(proposed: DataFrame, name: str) -> list[tuple[str, str, int]]:
    """How often each kind has each pattern of votes."""
    each = proposed.select(F.explode(name).alias("c")).select("c.kind", "c.votes")
    return [tuple(row) for row in each.groupBy("kind", "votes").count().collect()]


def estimate(counts: list[tuple[str, str, int]]) -> dict[tuple[str, str], float]:
    """Probability that candidates of a kind with these votes are real, by EM.

    Labelers vote independently given the truth; their rates are shared by all kinds, the share of
    real candidates is each kind's own.
    """
    def sigmoid(x: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

    belief = {(k, v): sigmoid(v.count("+") - 2 * v.count("-")) for k, v, _ in counts}
    for _ in range(EM_ROUNDS):
        rates = {}
        for truth in (0, 1):
            for j in range(len(LABELERS)):
                tally = dict.fromkeys("+-0", 1.0)
                for kind, votes, n in counts:
                    p = belief[kind, votes]
                    tally[votes[j]] += n * (p if truth else 1 - p)
                total = sum(tally.values())
                for vote, amount in tally.items():
                    rates[truth, j, vote] = math.log(amount / total)
        prior = {}
        for kind in {k for k, _, _ in counts}:
            mine = [(belief[k, v], n) for k, v, n in counts if k == kind]
            share = (1 + sum(p * n for p, n in mine)) / (2 + sum(n for _, n in mine))
            prior[kind] = math.log(share / (1 - share))
        for kind, votes, _ in counts:
            odds = sum(rates[1, j, v] - rates[0, j, v] for j, v in enumerate(votes))
            belief[kind, votes] = sigmoid(prior[kind] + odds)
    return belief


def train(counts: list[tuple[str, str, int]]) -> dict[tuple, float]:
    """Weights of the span classifier: logistic regression on kind and votes, fitted to the beliefs."""
    belief = estimate(counts)
    weights: dict[tuple, float] = {}
    total = sum(n for *_, n in counts) or 1
    rows = [
        ([("kind", k), *((j, v) for j, v in enumerate(votes))], belief[k, votes], n / total)
        for k, votes, n in counts
    ]
    squares: dict[tuple, float] = {}
    for _ in range(FIT_ROUNDS):
        slopes: dict[tuple, float] = {}
        for features, target, share in rows:
            logit = sum(weights.get(f, 0.0) for f in features)
            error = share * (1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) - target)
            for f in features:
                slopes[f] = slopes.get(f, 0.0) + error
        for f, slope in slopes.items():
            slope += 1e-5 * weights.get(f, 0.0)
            squares[f] = squares.get(f, 0.0) + slope * slope
            weights[f] = weights.get(f, 0.0) - 0.5 * slope / (math.sqrt(squares[f]) + 1e-9)
    return weights


def probability(weights: dict[tuple, float], span: Column) -> Column:
    """The classifier's value for a candidate, as a column expression."""
    def choose(value: Column, options: dict[str, float]) -> Column:
        chosen = F.lit(0.0)
        for option, weight in sorted(options.items()):
            chosen = F.when(value == option, F.lit(weight)).otherwise(chosen)
        return chosen

    kinds = {k[1]: w for k, w in weights.items() if k[0] == "kind"}
    terms = [choose(span["kind"], kinds)]
    for j in range(len(LABELERS)):
        options = {k[1]: w for k, w in weights.items() if k[0] == j}
        terms.append(choose(F.substring(span["votes"], j + 1, 1), options))
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms)))


def decide(found: Column, weights: dict[tuple, float]) -> Column:
    """The spans to report: valid base spans and the added kinds' likely candidates."""
    def keep(span: Column) -> Column:
        is_base = span["kind"].isin(*BASE)
        return (is_base & span["valid"]) | (~is_base & (probability(weights, span) >= CUTOFF))

    return F.filter(found, keep)


def render(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        tag = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        fresh = span["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, tag)).otherwise(done["out"]).alias("out"),
        )

    rest = F.char_length(text)
    whole = F.aggregate(
        ordered, start, step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, rest)),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def fit(docs: DataFrame, text_col: str = "text") -> dict[tuple, float]:
    """The classifier's weights from the votes on all documents."""
    proposed, name = propose(docs, [], text_col)
    return train(count_votes(proposed, name))


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, and personal data masked in their texts."""
    weights = fit(docs, text_col)
    proposed, name = propose(docs, docs.columns, text_col)
    text = masked(F.col(text_col), decide(F.col(name), weights))
    return proposed.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
