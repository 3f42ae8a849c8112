"""Personal data: fixed rules give the base spans, boosted trees decide on further candidates.

Everything over the texts is a SQL expression. A pattern's matches come from regexp_extract_all, their
places from the lengths of the gaps that split leaves. Two generators propose runs that may be secrets
or numbers of persons; they overlap each other and the base spans. Boosted trees over format and
context features, trained on the driver from written-out examples, give each a probability; those at the
calibrated threshold that meet no base span and no better candidate are added.

The patterns are rewritten so that no text makes the regex engine recurse or start again and again
within a run; places and matches stay those of the patterns in PATTERNS.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted, boost, threshold

#: Fixed: what the base spans are.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = ("email", "ip", "card", "phone")
#: Kinds that the trees add, with their generators.
ADDED = {
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+",
    "number": r"(?<![0-9A-Za-z])[0-9][0-9 ().-]{5,22}[0-9](?![0-9A-Za-z])",
}
#: Characters of context on either side; the precision that a threshold must reach on the examples.
CONTEXT, PRECISION = 24, 0.99
#: Matches whose places are summed up at once; code points in a piece that context is read from, CONTEXT at least.
RUN, PIECE = 200, 1024

FEATURES = (
    "chars", "digits", "lower", "upper", "marks", "turns", "hexadecimal", "named_secret",
    "named_number", "assigned", "quoted", "grouped",
)


def _places(text: Column, pattern: str) -> Column:
    """(start, end, match) of each match, in code points: gaps and matches take turns.

    Places are running sums. A list that grows match by match would be copied each time, so the matches are
    dealt into runs of RUN: first the sum of each run, then where each run starts, then the places within it.
    """
    pattern_ = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))
    matches = F.regexp_extract_all(text, pattern_, F.lit(0))
    both = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"))
    kind = "array<struct<start:int,end:int,match:string>>"

    def within(run: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            last = begin + F.length(x["match"])
            span = F.struct(begin.alias("start"), last.alias("end"), x["match"].alias("match"))
            return F.struct(last.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(run, start, step, lambda acc: acc["out"])

    def size(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["match"]))

    def in_runs(all_: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int")),
            lambda i: F.slice(all_, i * RUN + 1, F.lit(RUN)),
        )
        none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        starts = F.aggregate(
            F.transform(runs, size), none,
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), starts.alias("at")), lambda r: within(r["run"], r["at"])))

    def places(all_: Column) -> Column:
        return F.when(F.size(all_) > RUN, in_runs(all_)).when(F.size(all_) > 0, within(all_, F.lit(0))).otherwise(F.expr(f"cast(array() as {kind})"))

    return F.element_at(F.transform(F.array(both), places), 1)


def _when(text: Column, test: Column, value: Column) -> Column:
    return F.when(test, value).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)"))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits; `digits` has 1 to 19 digits."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _tagged(spans: Column, kind: str, with_features: Column | None = None) -> Column:
    """The spans as (kind, start, end), and x: their features in the text whose pieces are given."""

    def one(s: Column) -> Column:
        fields = [F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")]
        if with_features is not None:
            fields.append(_features(with_features, s).alias("x"))
        return F.struct(*fields)

    return F.transform(spans, one)


def base_spans(text: Column) -> dict[str, Column]:
    """(start, end, match) of each kind in the non-null `text`."""
    domain = "[A-Za-z0-9-]"
    # A dot that doesn't join two labels can't be in a domain; '%' may stand wherever it stood.
    joined = F.regexp_replace(text, rf"\.(?!{domain})|(?<!{domain})\.", "%")
    local = "[A-Za-z0-9._%+-]"
    email = _when(
        text, F.contains(text, F.lit("@")),
        _places(joined, rf"(?:(?<!{local})|\G){local}++@{domain}++\.[A-Za-z0-9.-]++"),
    )
    ip = _when(
        text, text.rlike(r"[0-9]\.[0-9]"),
        _places(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    )
    ip = F.filter(
        ip,
        lambda s: F.forall(
            F.split(s["match"], r"\."),
            lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
            & (F.right(p, F.lit(3)).cast("int") <= 255),
        ),
    )
    # A separator that doesn't stand between two digits ends a run of digits.
    runs = F.regexp_replace(text, r"(?<![0-9])[ -]|[ -](?![0-9])", "#")
    card = _when(text, text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), _places(runs, r"[0-9][0-9 -]{12,}+"))
    card = F.filter(
        card,
        lambda s: F.length(_digits(s["match"])).between(13, 19)
        & F.when(F.length(_digits(s["match"])).between(13, 19), _luhn(_digits(s["match"]))).otherwise(False),
    )
    phone = _when(text, text.rlike(r"\+[0-9]"), _places(text, r"\+[0-9][ ().0-9-]+[0-9]"))
    phone = F.filter(phone, lambda s: F.length(_digits(s["match"])).between(9, 15))
    return {"email": email, "ip": ip, "card": card, "phone": phone}


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _features(pieces: Column, s: Column) -> Column:
    """Format and context of a candidate, as a struct of doubles named after FEATURES; `pieces` are the text's, of PIECE."""
    m = s["match"]
    n = F.length(m)
    low = F.greatest(s["start"] - CONTEXT, F.lit(0))
    at = F.floor(s["start"] / PIECE).cast("int")
    # A place in a long text is found by reading from its beginning, so context comes out of the pieces around.
    around = F.concat(F.when(at > 0, F.get(pieces, at - 1)).otherwise(""), F.get(pieces, at))
    before = F.lower(F.substring(around, low + 1 - F.greatest(at - 1, F.lit(0)) * PIECE, s["start"] - low))
    last = F.floor(s["end"] / PIECE).cast("int")
    after = F.coalesce(F.substring(F.get(pieces, last), s["end"] + 1 - last * PIECE, F.lit(1)), F.lit(""))
    values = {
        "chars": n,
        "digits": _count(m, "[0-9]") / n,
        "lower": _count(m, "[a-z]") / n,
        "upper": _count(m, "[A-Z]") / n,
        "marks": _count(m, "[^0-9A-Za-z]") / n,
        "turns": _count(m, "(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]") / n,
        "hexadecimal": m.rlike("^[0-9a-fA-F]+$"),
        "named_secret": before.rlike("token|secret|passw|pwd|key|auth|bearer|credential"),
        "named_number": before.rlike(r"phone|tel|mobile|fax|call|ssn|social|passport|account|iban|card"),
        "assigned": before.rlike(r"[=:]\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("[\"']"),
        "grouped": m.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{2,3}[ .-][0-9]{4}$"),
    }
    return F.struct(*[values[f].cast("double").alias(f) for f in FEATURES])


def candidates(text: Column) -> Column:
    """(kind, start, end, x: features) of all that the generators propose."""
    tests = {"secret": r"[A-Za-z0-9_+/=-]{16}", "number": r"[0-9][0-9 ().-]{5,22}[0-9]"}

    def of(pieces: Column) -> Column:
        found = {k: _when(text, text.rlike(tests[k]), _places(text, pattern)) for k, pattern in ADDED.items()}
        return F.concat(*[_tagged(spans, kind, pieces) for kind, spans in found.items()])

    # One element, so that the pieces are cut once and not for each candidate.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))
    return F.element_at(F.transform(F.array(pieces), of), 1)


def examples(n: int = 900, seed: int = 11) -> list[tuple[str, int]]:
    """Written-out texts with one candidate each, and whether it is personal or secret."""
    rnd = random.Random(seed)
    syllables = "an er on the ing ti re st th ou en de la que ver ung ción ment".split()
    pick = lambda chars, k: "".join(rnd.choice(chars) for _ in range(k))
    word = lambda k=3: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, k)))
    prose = lambda k: " ".join(word() for _ in range(rnd.randint(1, k)))
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    digits = "0123456789"
    ascii_syllables = [s for s in syllables if s.isascii()]

    def secret() -> str:
        return rnd.choice([
            lambda: pick(hexa, rnd.choice([32, 40, 48, 64])),
            lambda: pick(alnum, rnd.randint(20, 44)),
            lambda: "sk_live_" + pick(alnum, 24),
            lambda: "AKIA" + pick(alnum[:26] + digits, 16),
        ])()

    def number() -> str:
        return rnd.choice([
            lambda: f"{pick(digits, 3)}-{pick(digits, 2)}-{pick(digits, 4)}",
            lambda: f"({pick(digits, 3)}) {pick(digits, 3)}-{pick(digits, 4)}",
            lambda: f"{pick(digits, 3)}.{pick(digits, 3)}.{pick(digits, 4)}",
            lambda: pick(digits, rnd.randint(9, 16)),
        ])()

    def harmless() -> str:
        return rnd.choice([
            lambda: "".join(rnd.choice(ascii_syllables) for _ in range(9)),
            lambda: "".join(rnd.choice(ascii_syllables) for _ in range(9)).upper(),
            lambda: "".join(rnd.choice(ascii_syllables) for _ in range(9)).title(),
            lambda: "-".join(rnd.choice(ascii_syllables) * 2 for _ in range(6)),
            lambda: "=" * rnd.randint(16, 60),
            lambda: "-" * rnd.randint(16, 60),
            lambda: "/".join(["docs", *(rnd.choice(ascii_syllables) * 2 for _ in range(5))]),
            lambda: f"{rnd.randint(1900, 2030)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}",
            lambda: f"{rnd.randint(1900, 2000)} - {rnd.randint(2001, 2030)}",
            lambda: f"{rnd.randint(100, 999)} {rnd.randint(100, 999)} {rnd.randint(100, 999)}",
            lambda: pick("0123456789", rnd.randint(7, 16)),
            lambda: "0." + pick(digits, rnd.randint(6, 12)),
        ])()

    names = ["token", "secret", "api_key", "password", "auth", "access key", "Bearer"]
    calls = ["phone", "tel", "mobile", "call", "ssn", "passport", "account", "card"]
    out = []
    for i in range(n):
        kind = i % 3
        if kind == 0:
            lead = rnd.choice([f'{rnd.choice(names)} = "%s"', f"{rnd.choice(names)}: %s", f"{rnd.choice(names)}=%s", f"{word()} %s"])
            out.append((f"{prose(8)} {lead % secret()} {prose(5)}", 1))
        elif kind == 1:
            lead = rnd.choice([f"{rnd.choice(calls)}: %s", f"{rnd.choice(calls)} %s", f"{rnd.choice(calls)} no. %s"])
            out.append((f"{prose(8)} {lead % number()} {prose(5)}", 1))
        else:
            lead = rnd.choice(["%s", "%s", f"{word()}: %s", f'"%s"'])
            out.append((f"{prose(8)} {lead % harmless()} {prose(5)}", 0))
    rnd.shuffle(out)
    return out


def train(spark: SparkSession) -> tuple[Boosted, float]:
    """The trees, and the threshold on the examples that they were calibrated on."""
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(examples())], "i int, text string, y int")
    found = rows.select("i", "y", F.inline(candidates(F.col("text")))).orderBy("i", "kind", "start")
    got = found.select("y", *[F.col("x")[f].alias(f) for f in FEATURES]).collect()  # as many as examples, about
    x = np.array([r[1:] for r in got], dtype=np.float64)
    y = np.array([r[0] for r in got], dtype=np.float64)
    model = boost(x, y)
    return model, max(0.5, threshold(model.probability(x[1::2]), y[1::2], PRECISION))


def _runs(spans: str) -> str:
    """SQL for runs of RUN of the spans, with the least start and the greatest end in each."""
    cut = f"transform(sequence(0, int((greatest(size({spans}), 1) - 1) div {RUN})), i -> slice({spans}, i * {RUN} + 1, {RUN}))"
    low = f"coalesce(array_min(transform(r, x -> x.start)), {2**31 - 1})"
    high = "coalesce(array_max(transform(r, x -> x.end)), 0)"
    return f"transform({cut}, r -> struct({low} as low, {high} as high, r as spans))"


def _beside(spans: str, others: str, test: str, rival: str) -> str:
    """SQL for the spans c that pass `test` and overlap no span x of the others that is a `rival`. Spans of a kind come
    sorted, so nearly all runs are passed over by their ends, and a text's spans are never compared pair by pair."""
    meets = (
        "exists(runs, r -> r.low < c.end and c.start < r.high"
        f" and exists(r.spans, x -> x.start < c.end and c.start < x.end and {rival}))"
    )
    # One element, so that the runs are made once and not for each span.
    return f"element_at(transform(array({_runs(others)}), runs -> filter({spans}, c -> {test} and not {meets})), 1)"


def find_pii(
    docs: DataFrame,
    model: tuple[Boosted, float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, base (kind, start, end of the base spans), added (the same and p), text.

    Places are code points, ends exclusive; base spans are ordered by kind and start, added ones by
    kind and start after them. Null counts as empty and has none. Rows don't shuffle; repeated rows come back
    repeated; an empty table gives an empty result; other columns are not read.
    """
    trees, least = model
    text = F.col("_text")
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kinds = base_spans(text)
    base = F.concat(*[_tagged(spans, kind) for kind, spans in kinds.items()])
    p = trees.sql([f"c.x.{f}" for f in FEATURES])
    scored = F.expr(f"transform(_proposed, c -> struct(c.kind as kind, c.start as start, c.end as end, {p} as p))")
    clear = F.expr(_beside("_scored", "_base", f"c.p >= {least:.6g}D", "true"))
    better = "(x.p > c.p or (x.p = c.p and (x.start < c.start or (x.start = c.start and x.kind > c.kind))))"
    best = F.expr(_beside("_clear", "_clear", "true", better))
    return (
        source.withColumn("_base", base)
        .withColumn("_proposed", candidates(text))
        .withColumn("_scored", scored)
        .withColumn("_clear", clear)
        .select(F.col("_id").alias(id_col), F.col("_base").alias("base"), F.sort_array(best).alias("added"), F.col("_text").alias("text"))
    )


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of find_pii's result: id and the text with each span replaced by its kind in angle brackets."""
    spans = F.array_sort(
        F.concat(
            F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
            F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        first = F.greatest(s["start"], acc["at"])
        gap = F.substring(F.col("text"), acc["at"] + 1, first - acc["at"])
        mark = F.when(s["end"] > acc["at"], F.concat(gap, F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    return found.select(id_col, F.aggregate(spans, start, step, rest).alias("text"))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, train(spark))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    base, added = _written(F.col("base")), _written(F.col("added"))
    joined = F.concat(base, F.when((base != "") & (added != ""), F.lit(",")).otherwise(""), added)
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined.alias("spans"))
