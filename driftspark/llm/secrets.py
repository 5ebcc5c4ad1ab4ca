"""Secret scan with a battery of randomness tests, with DataFrame functions only.

Fixed shapes give the base kinds: assign, access, hex. Besides, every long run of
base64-like characters is a candidate. Its encoding is inferred from its characters
(hexadecimal, base 32, base 36, alphanumeric, base 64 of either alphabet), and three tests
ask whether it is a random string of that alphabet: chi-squared uniformity, the number of
runs above and below the middle of the alphabet, and the lag-1 serial correlation. Each
has its own distribution for random strings (chi-squared, normal, normal), and a candidate
that one of them rejects at ``REJECT_Z`` is not a find.

How sure a find is depends on the length: a short word can pass as random. The p value
of a candidate is the chance that text of its length and encoding has as few equal pairs of
characters (the chi-squared statistic counts them). Text is modelled by fixed letter and
digit frequencies, which give mean and variance of the pairs; a scaled chi-squared
distribution with these stands for theirs. The Benjamini-Hochberg rule per length class holds
the share of false finds at ``FALSE_SHARE``. No p value depends on other candidates, so a
class needs no words in the corpus. Runs of letters in one case are words, except capitals in
base 32: a random alphanumeric string of 20 characters is one with a chance of 1e-7.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftspark.llm.common import stored

KINDS = ("assign", "access", "hex")

# Shapes of the base kinds (hex and access runs are whole runs, so a least length finds the same).
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
LEAST_VALUE = 6

# Alphabets of the encodings, in code order.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "alphanumeric": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
# Letter frequencies of English in percent, and the shares of small letters, capitals and digits in
# text of an encoding.
LETTERS = (
    12.70, 9.06, 8.17, 7.51, 6.97, 6.75, 6.33, 6.09, 5.99, 4.25, 4.03, 2.78, 2.76, 2.41, 2.36, 2.23, 2.02, 1.97, 1.93, 1.49,
    0.98, 0.77, 0.15, 0.15, 0.10, 0.07,
)
_MIXED_TEXT = (13 / 16, 1 / 8, 1 / 16)
TEXT_SHARES = {"hex": (0, 0, 1), "base32": (0, 1, 0), "base36": (7 / 8, 0, 1 / 8)}
REJECT_Z = 2.935  # two-sided, 1 % of random strings over the three tests
FALSE_SHARE = 0.05
BINS_PER_UNIT, LAST_BIN = 20, 2000


def _text_power(encoding: str, power: int) -> float:
    """Sum of the powers of the symbol frequencies of text in an encoding."""
    small, capital, digit = TEXT_SHARES.get(encoding, _MIXED_TEXT)
    letters = sum((x / sum(LETTERS)) ** power for x in LETTERS)
    return (small**power + capital**power) * letters + digit**power * 10 * 0.1**power


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per match of each pattern: (row, doc_id, kind, start, end, value), start and end in
    code points, and one row of kind ``text`` per row of the documents."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    found = []
    for kind, pattern in PATTERNS.items():
        p = _literal(pattern)
        # text = gap 1, match 1, gap 2, match 2, ..., last gap
        cut = f"""transform(
            zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (g, v) -> struct(g as gap, v as value)),
            (x, i) -> struct('{kind}' as kind, i as nth, char_length(x.gap) as gap, char_length(x.value) as size, x.value as value))"""
        found.append(f"CASE WHEN text RLIKE {p} THEN {cut} END")
    none = "struct('text' as kind, 0 as nth, 0 as gap, cast(null as int) as size, cast(null as string) as value)"
    cuts = rows.select("row", "doc_id", F.explode(F.expr(f"flatten(filter(array({', '.join(found)}, array({none})), x -> x is not null))")).alias("cut"))
    cuts = cuts.select("row", "doc_id", "cut.*").where("kind = 'text' OR value IS NOT NULL")
    order = Window.partitionBy("row", "kind").orderBy("nth")
    upto = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(order)
    return cuts.withColumn("end", upto).select(
        "row", "doc_id", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value"
    )


def _valid() -> str:
    return f"""kind IN ('access', 'hex', 'text', 'random')
        OR (kind = 'assign' AND char_length(regexp_extract(value, {_literal(ASSIGN)}, 2)) >= {LEAST_VALUE})"""


def battery(values: DataFrame) -> DataFrame:
    """Adds to rows with a column ``value`` (a candidate): ``encoding``, ``n`` (characters
without padding), ``chi_z``, ``runs_z``, ``serial_z``, ``statistic`` and ``text_z`` (far below
    0 where text of that length has more equal pairs).

    A test without variation to judge (one symbol only, all on one side) counts as not random.
    """
    rows = values.withColumn("plain", F.regexp_replace("value", "=+$", ""))
    hexadecimal = F.col("plain").rlike("^([0-9a-f]+|[0-9A-F]+)$")
    base36 = F.col("plain").rlike("^([0-9a-z]+|[0-9A-Z]+)$")
    rows = rows.withColumn(
        "encoding",
        F.when(hexadecimal, "hex").when(F.col("plain").rlike("^[A-Z2-7]+$"), "base32").when(base36, "base36")
        .when(F.col("plain").rlike("^[A-Za-z0-9]+$"), "alphanumeric").when(F.col("plain").rlike("^[A-Za-z0-9+/]+$"), "base64")
        .when(F.col("plain").rlike("^[A-Za-z0-9_-]+$"), "base64url").otherwise("mixed"),
    ).withColumn("plain", F.when(F.col("encoding").isin("hex", "base36"), F.lower("plain")).otherwise(F.col("plain")))
    alphabet = F.lit(None).cast("string")
    for name, symbols in ENCODINGS.items():
        alphabet = F.when(F.col("encoding") == name, symbols).otherwise(alphabet)
    rows = rows.withColumn("alphabet", alphabet).withColumn("m", F.char_length("alphabet")).withColumn("n", F.char_length("plain"))
    # sum of squared symbol counts, one pass over the text per symbol
    squares = "aggregate(split(alphabet, ''), 0D, (s, a) -> s + pow(CASE WHEN a = '' THEN 0 ELSE n - char_length(replace(plain, a, '')) END, 2))"
    rows = rows.withColumn("chi", F.expr(f"m / n * {squares} - n"))
    share, cubes = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name in ENCODINGS:
        share = F.when(F.col("encoding") == name, _text_power(name, 2)).otherwise(share)
        cubes = F.when(F.col("encoding") == name, _text_power(name, 3)).otherwise(cubes)
    pairs = F.col("n") * (F.col("n") - 1) / 2
    expected = pairs * share
    varies = expected * (1 - share) + 2 * pairs * (F.col("n") - 2) * (cubes - share * share)
    narrow = varies / (9 * expected * expected)
    equal = F.greatest((F.col("chi") + F.col("n")) * F.col("n") / F.col("m") - F.col("n"), F.lit(0.0)) / 2
    text_z = (F.pow(equal / expected, 1 / 3) - (1 - narrow)) / F.sqrt(narrow)
    rows = rows.withColumn("text_z", text_z)
    df = F.col("m") - 1
    spread = 2 / (9 * df)
    chi_z = (F.pow(F.greatest("chi", F.lit(0.0)) / df, 1 / 3) - (1 - spread)) / F.sqrt(spread)  # Wilson-Hilferty
    codes = "transform(filter(split(plain, ''), c -> c != ''), c -> cast(instr(alphabet, c) - 1 as double))"
    rows = rows.withColumn("chi_z", chi_z).withColumn("codes", F.expr(codes))
    rows = rows.withColumn("mean", F.expr("aggregate(codes, 0D, (s, x) -> s + x) / n")).withColumn(
        "high", F.expr("size(filter(codes, x -> x >= m / 2))")
    )
    steps = "zip_with(slice(codes, 1, n - 1), slice(codes, 2, n - 1), (a, b) -> {})"
    runs = f"1 + aggregate({steps.format('CASE WHEN (a >= m / 2) != (b >= m / 2) THEN 1 ELSE 0 END')}, 0, (s, x) -> s + x)"
    lag = f"aggregate({steps.format('(a - mean) * (b - mean)')}, 0D, (s, x) -> s + x)"
    square = "aggregate(codes, 0D, (s, x) -> s + (x - mean) * (x - mean))"
    rows = rows.withColumn("runs", F.expr(runs)).withColumn("low", F.col("n") - F.col("high"))
    product = 2.0 * F.col("high") * F.col("low")
    variance = product * (product - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    runs_z = F.when(variance > 0, F.abs(F.col("runs") - 1 - product / F.col("n")) / F.sqrt(F.when(variance > 0, variance)))
    rows = rows.withColumn("runs_z", F.coalesce(runs_z, F.lit(99.0))).withColumn("square", F.expr(square))
    serial = F.when(F.col("square") > 0, F.abs(F.expr(lag) / F.when(F.col("square") > 0, F.col("square"))) * F.sqrt("n"))
    rows = rows.withColumn("serial_z", F.coalesce(serial, F.lit(99.0)))
    return rows.withColumn("statistic", F.greatest("chi_z", "runs_z", "serial_z")).drop(
        "plain", "alphabet", "m", "chi", "codes", "mean", "high", "low", "runs", "square"
    )


def _judged(candidates: DataFrame) -> DataFrame:
    """Candidates with ``length_class``, ``bin`` of their ``text_z`` and ``is_random``: no test rejects
    them; two classes double the length."""
    scaled = F.ceil(F.col("text_z") * BINS_PER_UNIT)  # up: the p value of a bin is that of its upper end
    word = F.col("value").rlike("^[A-Z]?[a-z]+$")
    return battery(candidates).select(
        *candidates.columns,
        F.floor(F.log2("n") * 2).cast("int").alias("length_class"),
        F.least(F.greatest(scaled, F.lit(-LAST_BIN)), F.lit(LAST_BIN)).cast("int").alias("bin"),
        (~word & (F.col("statistic") <= REJECT_Z) & (F.col("chi_z") >= -REJECT_Z)).alias("is_random"),
    )


def _lower_tail(z: Column) -> Column:
    """Chance of a normal value below z, by a continued fraction; 1 from -1 up, where no rule looks."""
    x, part = F.greatest(-z, F.lit(1.0)), F.greatest(-z, F.lit(1.0))
    for k in range(24, 0, -1):
        part = x + k / part
    return F.when(z < -1, F.exp(-x * x / 2) / (part * math.sqrt(2 * math.pi))).otherwise(1.0)


def thresholds(judged: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(length_class, last_bin) by Benjamini-Hochberg over a histogram whose size does not
    grow with the rows; classes without finds are absent. A candidate that a test rejects counts
    as tested, with p = 1."""
    counts = judged.groupBy("length_class", "bin").agg(
        F.count(F.lit(1)).alias("tested"), F.sum(F.col("is_random").cast("int")).alias("random")
    )
    upto = Window.partitionBy("length_class").orderBy("bin")
    whole = Window.partitionBy("length_class")
    p = _lower_tail(F.col("bin") / BINS_PER_UNIT)
    allowed = false_share * F.sum("random").over(upto) / F.sum("tested").over(whole)
    ranked = counts.withColumn("p", p).withColumn("allowed", allowed)
    return ranked.where("random > 0 AND p <= allowed").groupBy("length_class").agg(F.max("bin").alias("last_bin"))


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, spans) for each row of the documents; spans by start, then kind.

    Null and empty texts have no spans. Repeated rows stay; other columns are left out.
    """
    spark = docs.sparkSession
    rows = stored(_matches(docs, doc_id, text).where(F.expr(_valid())), "matches")  # one pass over the texts
    # Candidates are few but dear: a set number of tasks. Stored, as a filter on the battery's outcome
    # would be moved below it and write it out again inside itself.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = rows.where("kind = 'random'").repartition(tasks, "row", "start")
    judged = stored(_judged(candidates), "judged")
    finds = judged.join(thresholds(judged), "length_class").where("bin <= last_bin AND is_random").select(*rows.columns)
    every = rows.where("kind != 'random'").unionByName(finds)
    rank = F.expr("array_position(array('assign', 'access', 'hex', 'random'), kind)")
    span = F.when(F.col("kind") != "text", F.struct("start", rank.alias("rank"), "end", "kind"))
    return every.groupBy("row", F.col("doc_id")).agg(F.array_sort(F.collect_list(span)).alias("spans"))


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(joined.format("filter(spans, s -> s.kind != 'random')")), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )
