"""Personal data, in DataFrame operations only: patterns propose spans, checks confirm them,
words nearby adjust their score.

Positions come from cutting the text at the matches: the pieces between them and the matches
themselves alternate, and their lengths add up to the offsets. The patterns give the spans of
the plain ones named beside them, but anchor the start of a match at the start of its run and
use possessive repeats, so that they take linear time on any text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order among spans with the same start.
KINDS = ("email", "ip", "card", "phone", "iban")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([ -]?[0-9])+ where it has 14 to 19 digits: runs begin and end where digits do
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    # \+[0-9][ ().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # added: country, check digits, account in one run or in groups of four
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
PART = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
# Score of a confirmed span by itself, what a word nearby adds, and the words.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
NEARBY, BONUS = 40, 0.1
CONTEXT = {
    "email": r"e-?mail|contact|write|address|courriel|correo|kontakt",
    "ip": r"\bip\b|host|server|address|login|adresse",
    "card": r"card|visa|master|credit|debit|carte|tarjeta|karte|pay",
    "phone": r"phone|tel|call|mobile|fax|cell|anruf|appel|m[oó]vil",
    "iban": r"iban|account|bank|konto|compte|cuenta",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """True if the digits of the text pass the Luhn check."""
    digits = _digits(text)
    n = F.length(digits)

    def step(total, i):
        d = F.substring(digits, n - i, 1).cast("int")  # i counts from the right, from 0
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def mod97(text: Column) -> Column:
    """True if an account number, its first four signs moved to the end and letters read as
    10 to 35, leaves 1 when divided by 97."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest, i):
        sign = F.ascii(F.substring(turned, i, 1))
        return F.when(sign <= 57, rest * 10 + sign - 48).otherwise(rest * 100 + sign - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"),
    "card": luhn,
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
    "iban": mod97,
}
HELPERS = [f"m_{name}" for name in (*KINDS, "chunks", "length")]
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:double>"


CUT = 256  # code points of a chunk of the text


def _once(value: Column, use) -> Column:
    """use(value), with the value computed a single time."""
    return F.get(F.transform(F.array(value), use), 0)


def _before(values: Column, kind: str, join) -> Column:
    """For each of the values what join makes of 0 and all before it. Runs of about the root of
    their number are gone through one by one, and then the runs, so that arrays that grow by one
    stay short: 20,000 values take some 3 million steps, not 200."""
    start = F.lit(0).cast(kind)
    none = F.array().cast(f"array<{kind}>")

    def totals(items, first):
        return F.aggregate(items, F.struct(first.alias("at"), none.alias("out")), lambda s, x: F.struct(
            join(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def by_runs(items):
        width = F.ceil(F.sqrt(F.size(items))).cast("int")
        begins = F.sequence(F.lit(1), F.size(items), width)
        return _once(F.transform(begins, lambda b: F.slice(items, b, width)), lambda runs: F.flatten(F.zip_with(
            runs, totals(F.transform(runs, lambda r: F.aggregate(r, start, join)), start), totals)))

    return F.when(F.size(values) > 0, _once(values, by_runs)).otherwise(none)


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """The text from start to end, put together from the chunks that it touches alone."""
    first = F.floor(start / CUT).cast("int")
    count = F.floor((end - 1) / CUT).cast("int") - first + 1
    joined = F.array_join(F.slice(chunks, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(end > start, F.substring(joined, start - first * CUT + 1, end - start)).otherwise("")


def _spans(kind: str) -> Column:
    """Confirmed spans of a kind, from the columns text, m_<kind> and m_chunks."""
    found, chunks, length = F.col(f"m_{kind}"), F.col("m_chunks"), F.col("m_length")
    pieces = F.split(F.col("text"), PATTERNS[kind], -1)
    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("match")))

    def place(pairs):
        ends = _before(F.transform(pairs, lambda p: p["gap"] + p["size"]), "int", lambda s, x: s + x)
        return F.zip_with(pairs, ends, lambda p, at: F.struct(
            (at + p["gap"]).alias("start"), (at + p["gap"] + p["size"]).alias("end"), p["match"].alias("match")))

    def spanned(s):
        around = F.concat(
            _between(chunks, F.greatest(s["start"] - NEARBY, F.lit(0)), s["start"]), F.lit(" "),
            _between(chunks, s["end"], F.least(s["end"] + NEARBY, length)))
        score = SCORES[kind] + F.when(around.rlike(f"(?i){CONTEXT[kind]}"), BONUS).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), score.alias("score"),
        )

    good = F.transform(F.filter(_once(pairs, place), lambda s: CHECKS[kind](s["match"])), spanned)
    empty = F.array().cast(f"array<{SPAN}>")
    return F.when(F.size(found) > 0, good.cast(f"array<{SPAN}>")).otherwise(empty)


def _matched(documents: DataFrame) -> DataFrame:
    """documents with _given, the text (null: empty), its matches per kind, its length, and, where
    there are matches, its chunks."""
    texted = documents.withColumn("_given", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    matched = texted.withColumns({f"m_{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, p in PATTERNS.items()})
    some = sum((F.size(f"m_{k}") for k in KINDS), F.lit(0)) > 0
    chunks = F.when(some, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)))
    return matched.withColumns({"m_chunks": chunks, "m_length": F.length("text")})


def find(documents: DataFrame, min_score: float = 0.0) -> DataFrame:
    """documents with the column pii: an array of spans (start, kind_no, end, kind, score) in
    order of start and kind, offsets in code points, end exclusive.

    Kinds email, ip (parts at most 255), card (Luhn), phone (10 to 15 digits) and iban
    (mod-97). Spans of different kinds may overlap. A null or empty text has no spans; every
    row keeps all its columns. Columns named pii, _given or m_<name> (HELPERS) are replaced. Spans
    scored under min_score are left out. Very long texts are read whole; the work on a match does
    not depend on the length of the text, and offsets take the power 1.5 of the matches."""
    found = _found(documents, min_score)
    return found.withColumn("text", F.col("_given")).drop("_given", *HELPERS)


def _found(documents: DataFrame, min_score: float) -> DataFrame:
    spans = F.array_sort(F.concat(*[_spans(k) for k in KINDS]))
    found = _matched(documents).withColumn("pii", spans)
    return found.withColumn("pii", F.filter("pii", lambda s: s["score"] >= min_score)) if min_score > 0 else found


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(documents: DataFrame, min_score: float = 0.0) -> DataFrame:
    """documents with every span replaced by its kind in angle brackets; all columns, same
    rows. Where spans overlap, the first stands and takes the others in. n_chars, if there is
    such a column, follows the new text. Null texts stay null."""

    chunks, length = F.col("m_chunks"), F.col("m_length")

    def cleaned(spans):
        furthest = _before(F.transform(spans, lambda s: s["end"]), "int", lambda at, x: F.greatest(at, x))
        placed = F.zip_with(spans, furthest, lambda s, at: F.struct(
            at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind")))
        parts = F.transform(F.filter(placed, lambda p: p["start"] >= p["at"]), lambda p: F.concat(
            _between(chunks, p["at"], p["start"]), F.lit("<"), F.upper(p["kind"]), F.lit(">")))
        return F.concat(F.array_join(parts, ""), _between(chunks, F.array_max(F.transform(spans, lambda s: s["end"])), length))

    clean = F.when(F.size("pii") > 0, _once(F.col("pii"), cleaned)).otherwise(F.col("_given"))
    out = _found(documents, min_score).withColumn("text", clean)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("pii") > 0, F.length("text").cast(
            documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
