"""Personal data by weak supervision (DataFrame functions only; the fit is a small table).

Candidates are the matches of the four base patterns, valid or not, and of one wider pattern
(spelled-out e-mail addresses, IPv6, telephone numbers without a plus sign). Five labelers
vote on each: the base pattern, a validator (check digits, ranges, numbers of digits), a
gazetteer (top-level domains, card issuers, calling codes, reserved addresses), context words
before the span, and the characters beside it. Spark counts how often each combination of
kind, votes and shape occurs: at most 4 x 3^5 x 27 cells, whatever the input. From these counts
expectation-maximisation estimates how reliable each labeler is for each kind, and its
posteriors train a logistic classifier on votes and shape, which Spark then evaluates on
every candidate. A valid base match always stays; another candidate is added if the
classifier gives it ADD_AT or more and it overlaps no base match.

Start and end of a match follow from the lengths of the matches and of the text between
them, by running sums that take n log n steps for n matches, and overlaps are found by binary search. Possessive
quantifiers and a look-behind keep the base patterns linear; they match the same spans.

Defined results: null text is empty and has no spans; an empty table gives no rows and fits
nothing; rows come back one for one, their columns inside ``row``, the results inside ``found``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import whole_row, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns of the contract, with possessive quantifiers where they change nothing.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base patterns; what they are follows from their characters.
WIDE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{1,63}){1,8}"
    r"|(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])"
    r"|(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|00[0-9]{1,3}[\x20.-]|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
)
#: Word and number lists of the labelers.
TOP_LEVEL_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca", "jp", "cn"]
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|38)"
CALLING_CODES = r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_ADDRESS = r"^(?:0|127|22[4-9]|2[3-5][0-9])\."
CUES = {
    "email": r"(?:e-?mail|mail|contact|write|correo|courriel|adresse)\W*$",
    "ip": r"(?:\bip|address|server|host|from|adresse)\W*$",
    "card": r"(?:card|visa|mastercard|credit|carte|tarjeta|karte|payment)\W*(?:no\.?|number|nr\.?)?\W*$",
    "phone": r"(?:tel|phone|call|fax|mobile|telefon|téléphone|teléfono|handy)\W*$",
}
COUNTER_CUES = r"(?:version|isbn|issn|order|invoice|article|page|section|chapter|build|id)\W*(?:no\.?|number|nr\.?)?\W*$"
CONTEXT = 24
ADD_AT = 0.5
#: Characters of the pieces that texts are redacted in.
PIECE = 1024
EM_ROUNDS = 50
LABELERS = ("pattern", "validator", "gazetteer", "context", "beside")
SHAPES = ("length", "share", "parts")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass; other lengths are not looked at."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return x.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return _luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _running(values: Column, combine) -> Column:
    """For each place of an array what ``combine`` (sum or maximum) gives up to there: n log n steps, by doubling."""
    n = F.size(values)
    rounds = F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int"))).otherwise(F.array().cast("array<int>"))

    def double(held, k):
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(held, lambda x, i: F.when(i >= back, combine(x, F.get(held, i - back))).otherwise(x))

    return F.aggregate(rounds, values, double)


def _before(sorted_: Column, below) -> Column:
    """How many entries at the front of an array satisfy ``below`` (all others come behind them): a binary search."""
    n = F.size(sorted_)
    rounds = F.sequence(F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))

    def step(at, k):
        to = at + F.call_function("shiftleft", F.lit(1), k)
        return F.when((to <= n) & below(F.get(sorted_, to - 1)), to).otherwise(at)

    return F.aggregate(rounds, F.lit(0), step)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often and wherever (in lambdas, too) it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(matches: Column, gaps: Column) -> Column:
    """Spans of the matches, from what lies between them; ``before`` and ``after`` are the neighbours."""
    empty = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")

    def placed(held):
        # a match ends behind all gaps and matches up to it
        lengths = F.transform(held["m"], lambda m, i: F.length(m) + F.length(F.get(held["g"], i)))

        def span(ends):
            def one(match, i):
                gap, after, end = F.get(held["g"], i), F.get(held["g"], i + 1), F.get(ends, i)
                return F.struct(
                    (end - F.length(match)).alias("start"), end.alias("end"), match.alias("text"), F.lower(F.right(gap, F.lit(CONTEXT))).alias("before"), F.left(after, F.lit(1)).alias("after")
                )

            return F.transform(held["m"], one)

        return _let(_running(lengths, lambda x, y: x + y), span)

    return F.when(F.size(matches) > 0, _let(F.struct(matches.alias("m"), gaps.alias("g")), placed)).otherwise(empty)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _features(kind: str, span: Column, base: bool) -> Column:
    """A candidate with its votes and shape. base: from the base pattern, else from the wide one."""
    text, before, after = span["text"], span["before"], span["after"]
    digits = _digits(text)
    valid = _valid(kind, text) if base else F.lit(False)
    if kind == "email":
        last = F.lower(F.regexp_extract(text, r"([A-Za-z0-9-]+)$", 1))
        validator, gazetteer = _vote(last.rlike("^[a-z]{2,}$"), last.rlike("^[0-9-]+$")), _vote(last.isin(TOP_LEVEL_DOMAINS), F.length(last) < 2)
    elif kind == "ip":
        validator = _vote(valid if base else F.lit(True), ~valid if base else F.lit(False))
        gazetteer = _vote(~text.rlike(RESERVED_ADDRESS), text.rlike(RESERVED_ADDRESS))
    elif kind == "card":
        validator, gazetteer = _vote(valid, ~valid), _vote(digits.rlike(CARD_ISSUERS) & F.length(digits).between(13, 19), ~F.length(digits).between(12, 19))
    else:
        n = F.length(digits)
        validator, gazetteer = _vote(n.between(9, 15), ~n.between(7, 15)), _vote(text.rlike(CALLING_CODES), ~text.rlike(r"^[+(0-9]"))
    outside = lambda x: (x == "") | ~x.rlike(r"[A-Za-z0-9]")
    apart = outside(F.right(before, F.lit(1))) & outside(after)
    n = F.length(text)
    bin_ = lambda x, *edges: sum((F.when(x >= e, 1).otherwise(0) for e in edges[1:]), F.when(x >= edges[0], 1).otherwise(0))
    return F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        valid.alias("base"),
        (_vote(valid, ~valid) if base else F.lit(0)).alias("pattern"),
        validator.alias("validator"),
        gazetteer.alias("gazetteer"),
        _vote(before.rlike(CUES[kind]), before.rlike(COUNTER_CUES)).alias("context"),
        _vote(apart, ~apart).alias("beside"),
        bin_(n, 10, 17).alias("length"),
        bin_(F.length(digits) / F.greatest(n, F.lit(1)), 0.3, 0.8).alias("share"),
        bin_(F.length(F.regexp_replace(text, r"[A-Za-z0-9]", "")), 1, 4).alias("parts"),
    )


def candidates(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns to keep) and ``spans``: all candidates with votes and shape."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    patterns = BASE | {"wide": WIDE}
    found = docs.select(whole_row(docs, keep).alias("row"), body.alias("body"), *(F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()))
    parted = found.select("row", *(f"m_{k}" for k in patterns), *(F.when(F.size(f"m_{k}") > 0, F.split("body", p, -1)).alias(f"g_{k}") for k, p in patterns.items()))
    placed = parted.select("row", *(_spans(F.col(f"m_{k}"), F.col(f"g_{k}")).alias(f"s_{k}") for k in patterns))
    is_email, is_ip = (lambda s: s["text"].rlike("[(\\[]at[)\\]]")), (lambda s: s["text"].rlike("^[0-9A-Fa-f:]+$"))
    wide = {"email": is_email, "ip": lambda s: is_ip(s) & ~is_email(s), "card": None, "phone": lambda s: ~is_ip(s) & ~is_email(s)}
    parts = []
    featured = lambda kind, base: lambda s: _features(kind, s, base)
    for k in KINDS:
        parts.append(F.transform(f"s_{k}", featured(k, True)))
        if wide[k] is not None:
            parts.append(F.transform(F.filter("s_wide", wide[k]), featured(k, False)))
    return placed.select("row", F.concat(*parts).alias("spans"))


def _fit(cells: list[tuple]) -> dict[str, float]:
    """Weights of the span classifier from counted cells (kind, votes, shape, n)."""
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        own = [(c[1:6], c[-1]) for c in cells if c[0] == kind]
        votes: dict[tuple, int] = defaultdict(int)
        for v, n in own:
            votes[v] += n
        if not votes:
            continue
        belief = {v: min(max((sum(v) + 5) / 10, 0.05), 0.95) for v in votes}
        for _ in range(EM_ROUNDS):
            weight = {y: 1.0 + sum(n * (belief[v] if y else 1 - belief[v]) for v, n in votes.items()) for y in (0, 1)}
            seen = {(y, j, x): 0.0 for y in (0, 1) for j in range(5) for x in (-1, 0, 1)}
            for v, n in votes.items():
                for j, x in enumerate(v):
                    seen[1, j, x] += n * belief[v]
                    seen[0, j, x] += n * (1 - belief[v])
            # pseudo-counts say what a labeler is for: votes agree with the class more often than not
            prior = {(y, x): 4.0 if x == (1 if y else -1) else 2.0 if x == 0 else 1.0 for y in (0, 1) for x in (-1, 0, 1)}
            rate = {(y, j, x): math.log((s + prior[y, x]) / (weight[y] + 7.0)) for (y, j, x), s in seen.items()}
            for v in votes:
                odds = math.log(weight[1] / weight[0]) + sum(rate[1, j, x] - rate[0, j, x] for j, x in enumerate(v))
                belief[v] = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
        posterior |= {(kind, v): p for v, p in belief.items()}
    weights: dict[str, float] = defaultdict(float)
    rows = [([f"{c[0]}", *(f"{c[0]}:{name}={x}" for name, x in zip((*LABELERS, *SHAPES), c[1:9]))], posterior[c[0], c[1:6]], c[-1]) for c in cells]
    total = sum(r[2] for r in rows) or 1
    square: dict[str, float] = defaultdict(lambda: 1e-6)
    for _ in range(300):  # AdaGrad over the cells
        slope: dict[str, float] = defaultdict(float)
        for names, p, n in rows:
            z = sum(weights[x] for x in names)
            # rare cells count by the square root, so that they are learned too
            error = (1 / (1 + math.exp(-max(min(z, 30), -30))) - p) * math.sqrt(n / total)
            for x in names:
                slope[x] += error
        for x, g in slope.items():
            g += 1e-4 * weights[x]
            square[x] += g * g
            weights[x] -= 0.3 * g / math.sqrt(square[x])
    return dict(weights)


def _score(span: Column, weights: dict[str, float]) -> Column:
    if not weights:
        return F.lit(0.0)
    table = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))
    of = lambda key: F.coalesce(F.try_element_at(table, key), F.lit(0.0))
    z = of(span["kind"])
    for name in (*LABELERS, *SHAPES):
        z = z + of(F.concat(span["kind"], F.lit(f":{name}="), span[name].cast("string")))
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``found``: base and all, both arrays of (kind, start, end) by kind, then start."""
    held = written(candidates(docs, text, keep), "pii-candidates")
    cells = held.select(F.explode("spans").alias("s")).groupBy(*(F.col(f"s.{x}").alias(x) for x in ("kind", *LABELERS, *SHAPES))).count()
    weights = _fit(sorted(tuple(x) for x in cells.collect()))  # a bounded number of cells
    brief = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    place = F.array(*(F.lit(k) for k in KINDS))
    order = lambda s: F.struct(F.array_position(place, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    marked = held.select("row", F.transform(F.filter("spans", lambda s: s["base"]), brief).alias("base"), F.filter("spans", lambda s: ~s["base"]).alias("other"))
    of_kind = lambda kind: lambda s: s["kind"] == kind

    def overlaps(s, own):
        # spans of a kind ascend and do not overlap: the last one that begins before the end of s reaches farthest
        return _let(_before(own, lambda b: b["start"] < s["end"]), lambda n: F.coalesce(F.get(own, n - 1)["end"] > s["start"], F.lit(False)))

    def free(kinds):
        return F.filter("other", lambda s: (_score(s, weights) >= ADD_AT) & ~reduce(lambda x, y: x | y, (overlaps(s, kinds[k]) for k in KINDS)))

    added = F.when(F.size("other") > 0, _let(F.struct(*(F.filter("base", of_kind(k)).alias(k) for k in KINDS)), free)).otherwise(F.col("other"))
    distinct = lambda found: F.filter(found, lambda s, i: (i == 0) | (F.get(found, i - 1) != s))
    ordered = _let(F.array_sort(F.transform(F.concat("base", F.transform(added, brief)), order)), distinct)
    everything = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return marked.select("row", F.struct("base", everything.alias("all")).alias("found"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns, each span of the text replaced by its kind in angle brackets.

    Spans that overlap are one cut, named after the first. The text is taken apart into pieces of PIECE characters,
    so finding a place in it does not read it from the start.
    """
    body = F.col(f"row.{text}")
    by_start = F.array_sort(F.transform("found.all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def cuts_of(spans):
        def reached(reach):
            opens = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(reach, i - 1)))

            def cuts(firsts):
                def cut(i, k):
                    last = F.coalesce(F.get(firsts, k + 1), F.size(spans)) - 1
                    return F.struct(F.get(spans, i)["start"].alias("start"), F.get(reach, last).alias("end"), F.concat(F.lit("<"), F.get(spans, i)["kind"], F.lit(">")).alias("name"))

                return F.transform(firsts, cut)

            return _let(opens, cuts)

        return _let(_running(F.transform(spans, lambda s: s["end"]), F.greatest), reached)

    def without(cuts):
        def clean(piece, c):
            begin, end = c * PIECE, c * PIECE + F.length(piece)

            def part(t, low, high):
                left = F.when(t == low, begin).otherwise(F.get(cuts, t - 1)["end"])
                right = F.when(t == high, end).otherwise(F.get(cuts, t)["start"])
                name = F.when((t < high) & (F.get(cuts, t)["start"] >= begin), F.get(cuts, t)["name"]).otherwise("")
                return F.concat(F.substring(piece, left - begin + 1, F.greatest(right - left, F.lit(0))), name)

            def parts(at):
                whole = F.transform(F.sequence(at["low"], at["high"]), lambda t: part(t, at["low"], at["high"]))
                return F.when(at["low"] >= at["high"], piece).otherwise(F.array_join(whole, ""))

            return _let(F.struct(_before(cuts, lambda x: x["end"] <= begin).alias("low"), _before(cuts, lambda x: x["start"] < end).alias("high")), parts)

        return F.array_join(F.transform(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), clean), "")

    clean = F.when(F.size("found.all") > 0, _let(_let(by_start, cuts_of), without)).otherwise(body)
    return found.select(F.col("row").withField(text, clean).alias("row")).select("row.*")
