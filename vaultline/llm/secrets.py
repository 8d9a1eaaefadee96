r"""Secret scan: fixed patterns plus a randomness test battery.

Three kinds of spans come from patterns (assignments of password-like names,
access key ids, long hex runs).  A fourth kind, ``random``, comes from a test
battery over every long token:

1. the encoding is inferred from the token's characters (decimal, hex,
   base32, letters, alphanumeric, base64), which gives the alphabet size K;
2. three tests ask whether the token could be random over its K symbols:
   chi-squared uniformity (with the exact multinomial mean and variance, so short
   tokens count fairly; its tail by the gamma approximation of Wilson and
   Hilferty), a runs test about the middle of the alphabet, and the lag-1 serial
   correlation of the symbol numbers.  Runs and serial correlation depend on each
   other, so the p-values are joined by the smallest one times three, which holds
   under any dependence;
3. Benjamini-Hochberg control at ``FDR`` on these p-values, within length strata
   over all tokens of the corpus, says which tokens are structured;
4. a token that is not must also be unlike ordinary text: a p-value from symbol
   coincidences (text repeats symbols more often than chance) and
   character-class changes (text rarely mixes classes), both with
   length-dependent mean and variance, under the same control.  Spans are the
   tokens that pass both.

The control needs only counts per (stratum, p-value bin), an aggregate of
bounded size, not a global sort.

Everything is DataFrame expressions.  Match positions come from cutting the
text at the matches: the start of match i is the length of everything before.

Edge cases: NULL text is empty and has no spans; rows with NULL ids and
repeated rows are scanned like any other; an empty table gives an empty
result; texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import table, text_or_empty, written

# The base patterns as the contract states them.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# "one or more, then keep those of at least n characters" is the same as "at
# least n" for these two: a match always takes the whole run of its class.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6  # characters of an assigned value

FDR = 0.01  # share of false discoveries allowed in each length stratum
TEXT_COINCIDENCE = 0.065  # chance that two letters of ordinary text are equal
TEXT_SWITCH = 0.08  # chance that neighbours in a text token differ in class
STRATA = (24, 32, 48, 96)  # upper length bounds; the last stratum is open
BINS_PER_DECADE = 20
TOP_BIN = 800  # p-values below 1e-40 share the last bin


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _matches(pattern: str) -> Column:
    """array<struct<s, e, m>> of all matches in column ``text`` (code points)."""
    p = _quoted(pattern)
    spans = "array<struct<s:int,e:int,m:string>>"
    # x['0'] is a match, x['1'] the text between the last match and it; the
    # piece after the last match pairs with no match and is skipped.
    return F.expr(f"""
      IF(NOT rlike(text, {p}), CAST(array() AS {spans}),
        aggregate(
          arrays_zip(regexp_extract_all(text, {p}, 0), split(text, {p}, -1)),
          named_struct('at', 0, 'out', CAST(array() AS {spans})),
          (a, x) -> IF(x['0'] IS NULL, a, named_struct(
            'at', a.at + length(x['1']) + length(x['0']),
            'out', concat(a.out, array(named_struct(
               's', a.at + length(x['1']), 'e', a.at + length(x['1']) + length(x['0']), 'm', x['0']))))),
          a -> a.out))""")


# Alphabets in symbol order.
_ALPHABETS = {
    "dec": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "b32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "low": "abcdefghijklmnopqrstuvwxyz",
    "abc": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "aln": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
}


def _tail(z: str) -> str:
    """P(Z > z) of a standard normal, to a relative error below 1e-6: a
    polynomial near 0, a continued fraction in the tail (no cancellation)."""
    x = f"abs({z})"
    t = f"(1D / (1D + 0.2316419D * {x}))"
    poly = (f"({t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + "
            f"{t} * 1.330274429D)))))")
    fraction = f"({x} + 14D / {x})"
    for k in range(13, 0, -1):
        fraction = f"({x} + {k}D / {fraction})"
    density = f"(exp(-least({x}, 37D) * least({x}, 37D) / 2) / sqrt(2 * pi()))"
    upper = f"({density} * IF({x} < 2.5D, {poly}, 1D / {fraction}))"
    return f"IF({z} < 0, 1D - {upper}, {upper})"


def with_battery(tokens: DataFrame) -> DataFrame:
    """Adds ``p_random`` and ``p_text`` to rows with a string column ``token``."""
    t = tokens.withColumn("core", F.regexp_replace("token", "=+$", ""))
    t = t.withColumn(
        "enc",
        F.expr("""CASE WHEN rlike(core, '^[0-9]*$') THEN 'dec' WHEN rlike(core, '^[0-9a-f]+$') THEN 'hex'
                  WHEN rlike(core, '^[0-9A-F]+$') THEN 'HEX' WHEN rlike(core, '^[A-Z2-7]+$') THEN 'b32'
                  WHEN rlike(core, '^[a-z]+$') THEN 'low' WHEN rlike(core, '^[A-Za-z]+$') THEN 'abc'
                  WHEN rlike(core, '^[A-Za-z0-9]+$') THEN 'aln' ELSE 'b64' END"""),
    )
    alphabet = F.create_map(*[F.lit(x) for kv in _ALPHABETS.items() for x in kv])
    t = t.withColumn("alphabet", alphabet[F.col("enc")])
    t = t.withColumn("k", F.length("alphabet").cast("double")).withColumn("l", F.length("core").cast("double"))
    t = t.withColumn("v", F.expr(
        "transform(sequence(1, greatest(1, length(core))), i -> CAST(locate(substring(core, i, 1), alphabet) AS double))"))
    t = t.withColumn("sq", F.expr(
        "aggregate(array_distinct(v), 0D, (a, s) -> a + pow(size(filter(v, x -> x = s)), 2))"))
    t = t.withColumn("mean", F.expr("aggregate(v, 0D, (a, x) -> a + x) / l"))
    # Chi-squared over its mean, as a gamma variable with the exact variance.
    t = t.withColumn("df", F.expr("(k - 1) * l / greatest(l - 1, 1D)"))
    t = t.withColumn("z_chi", F.expr(
        "(pow(greatest((k / greatest(l, 1D) * sq - l) / (k - 1), 0D), 1D / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df))"))
    # Runs above and below the middle of the alphabet.
    t = t.withColumn("n1", F.expr("CAST(size(filter(v, x -> x > k / 2)) AS double)"))
    t = t.withColumn("runs", F.expr(
        "1D + aggregate(sequence(1, size(v) - 1), 0D, (a, i) -> a + IF((v[i] > k / 2) <> (v[i - 1] > k / 2), 1D, 0D))"))
    t = t.withColumn("mu", F.expr("2 * n1 * (l - n1) / l + 1"))
    t = t.withColumn("z_runs", F.expr(
        "IF((mu - 1) * (mu - 2) <= 0, -sqrt(l), (runs - mu) / sqrt((mu - 1) * (mu - 2) / (l - 1)))"))
    t = t.withColumn("dev", F.expr("aggregate(v, 0D, (a, x) -> a + pow(x - mean, 2))"))
    t = t.withColumn("z_ser", F.expr(
        "IF(dev = 0, sqrt(l), (aggregate(sequence(1, size(v) - 1), 0D, (a, i) -> a + (v[i] - mean) * (v[i - 1] - mean)) / dev + 1 / l) * sqrt(l))"))
    # Written out as columns, so that each tail is evaluated once.
    t = t.withColumn("p_chi", F.expr(_tail("z_chi")))
    t = t.withColumn("p_runs", F.expr(f"2 * {_tail('abs(z_runs)')}"))
    t = t.withColumn("p_ser", F.expr(f"2 * {_tail('abs(z_ser)')}"))
    t = t.withColumn("p_random", F.expr("least(1D, 3 * least(p_chi, p_runs, p_ser))"))
    # Ordinary text: coincidences and class changes.
    t = t.withColumn("z_same", F.expr(
        f"(l * (l - 1) * {TEXT_COINCIDENCE} - (sq - l)) / sqrt(2 * l * (l - 1) * {TEXT_COINCIDENCE} * (1 - {TEXT_COINCIDENCE}))"))
    t = t.withColumn("kinds", F.expr("translate(core, '{}', '{}')".format(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", "A" * 26 + "a" * 26 + "0" * 10 + "+" * 4)))
    t = t.withColumn("switches", F.expr(
        "aggregate(sequence(1, greatest(1, length(kinds) - 1)), 0D, (a, i) -> a + IF(substring(kinds, i, 1) <> substring(kinds, i + 1, 1), 1D, 0D))"))
    t = t.withColumn("z_mix", F.expr(
        f"(switches - (l - 1) * {TEXT_SWITCH}) / sqrt((l - 1) * {TEXT_SWITCH} * (1 - {TEXT_SWITCH}))"))
    t = t.withColumn("z_text", F.expr("(z_same + z_mix) / sqrt(2D)"))
    t = t.withColumn("p_text", F.expr(_tail("z_text")))
    # A core of under 20 characters (all padding) is never random.
    t = t.withColumn("p_random", F.when(F.col("l") < 20, 1e-300).otherwise(F.col("p_random")))
    t = t.withColumn("p_text", F.when(F.col("l") < 20, 1.0).otherwise(F.col("p_text")))
    return t.select(*tokens.columns, "p_random", "p_text", F.col("l").alias("token_length"))


def _stratum(length: Column) -> Column:
    return sum(((length >= b).cast("int") for b in STRATA), F.lit(0))


def _bin(p: str) -> Column:
    """-log10(p) in steps; the smallest p-values share the last bin."""
    return F.least(F.lit(TOP_BIN), F.floor(-F.log10(F.greatest(F.col(p), F.lit(1e-300))) * BINS_PER_DECADE)).cast("int")


def fdr_bins(tested: DataFrame, bin_: str = "bin") -> dict[int, int]:
    """Per length stratum, the least p-value bin that Benjamini-Hochberg
    accepts.  The driver gets one row per (stratum, bin): at most
    ``(len(STRATA) + 1) * (TOP_BIN + 1)`` rows whatever the corpus."""
    counts = tested.groupBy("stratum", F.col(bin_).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = {}
    for s in {r["stratum"] for r in counts}:
        rows = sorted(((r["bin"], r["n"]) for r in counts if r["stratum"] == s), reverse=True)
        m, seen = sum(n for _, n in rows), 0
        for b, n in rows:
            seen += n
            if 10.0 ** (-b / BINS_PER_DECADE) * m / seen <= FDR:  # the bin's largest p-value
                found[s] = b
    return found


def _rejected(tested: DataFrame, bin_: str) -> Column:
    """Whether a token's hypothesis is rejected in its stratum."""
    out = F.lit(False)
    for s, b in sorted(fdr_bins(tested, bin_).items()):
        out = out | ((F.col("stratum") == s) & (F.col(bin_) >= b))
    return out


def decided(tested: DataFrame) -> DataFrame:
    """Rows (.., p_random, p_text, token_length) of all tokens with ``random``: not
    shown to be structured, and shown to be no ordinary text."""
    binned = written(tested.withColumn("stratum", _stratum(F.col("token_length"))).withColumn(
        "structure", _bin("p_random")).withColumn("unlike", _bin("p_text")).drop("p_random", "p_text"), "secret-tokens")
    return binned.withColumn("random", _rejected(binned, "unlike") & ~_rejected(binned, "structure"))


def scan(docs: DataFrame) -> DataFrame:
    """Per input row (doc_id): the spans of each kind as arrays.

    Columns: doc_id, assign, access, hex, random: array<struct<s, e, m>>.
    """
    text = docs.select("doc_id", text_or_empty().alias("text"))
    # The assigned value is group 2; a short one drops the whole match, after
    # matching (so it still hides what lies inside it).
    first = text.select(
        "doc_id",
        F.filter(_matches(ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], "^" + ASSIGN, 2)) >= MIN_VALUE).alias("assign"),
        _matches(ACCESS).alias("access"),
        _matches(HEX).alias("hex"),
        _matches(TOKEN).alias("tokens"),
    )
    # Written once: the corpus-wide thresholds need all tokens before any
    # span can be decided.  The row number inside the file keeps rows apart.
    first = written(first.withColumn("row", F.monotonically_increasing_id()), "secrets")
    one = first.select("row", F.posexplode("tokens").alias("pos", "t")).select("row", "pos", F.col("t.m").alias("token"))
    tested = decided(with_battery(one).select("row", "pos", "p_random", "p_text", "token_length"))
    hits = tested.filter("random").groupBy("row").agg(F.collect_set("pos").alias("hit"))
    return (
        first.join(hits, "row", "left")
        .withColumn("random", F.expr(
            "IF(hit IS NULL, CAST(array() AS array<struct<s:int,e:int,m:string>>), transform(array_sort(hit), i -> tokens[i]))"))
        .select("doc_id", "assign", "access", "hex", "random")
    )


def _listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    def numbered(kind: str, number: int) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["s"].alias("s"), F.lit(number).alias("k"), x["e"].alias("e")))

    parts = [numbered(k, i) for i, k in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of every document."""
    found = scan(table(spark, sf_dir, "documents"))
    size = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return found.select(
        "doc_id", size("assign"), size("access"), size("hex"), size("random"),
        F.sha2(_listed(KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
    )
