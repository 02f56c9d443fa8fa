"""Personal data (7): candidate spans, gradient-boosted trees, calibrated thresholds. Native.

* Generators. Four fixed rules (email, ip, card, phone) and two loose ones (``loose_email``:
  also spelled "at" and "dot"; ``loose_number``: any groups of digits) propose spans, which
  may overlap. Positions come from the lengths of the pieces between matches (``split``) and
  of the matches (``regexp_extract_all``), summed up in a window per document and rule.
  The patterns are possessive and anchored at the start of a run of characters (or at the
  end of the match before, ``\\G``), so they are linear in the text and do not recurse.
* Model. Spark ML's ``GBTClassifier`` learns from format and context features which loose
  candidates are personal data. Its labels do not depend on the form that the fixed rules ask
  for. Positive: accepted spans rewritten in their own contexts (phones without plus or country,
  with other separators; cards with other separators; addresses with "at" and "dot" spelled
  out). Negative: the corpus's own numbers in the form of dates, versions, and digits without a
  check sum, and such numbers made of accepted spans' digits. Candidates that are neither have
  no label. It is fitted on all of these examples of two thirds of the documents.
* Threshold. Per loose rule the lowest score, from one half up, down to which all examples of
  the other third (held out) keeps a precision of ``min_precision``; a rule without held-out
  examples takes 0.9. Without accepted spans to learn from, no span is added.

Fixed rules' spans always stay; an added span (kind ``loose_email`` or ``loose_number``) is
one that scores above its threshold and overlaps no fixed rule's span.

The text is read in one pass that leaves only candidates (checkpointed); what is shuffled
afterwards are candidates.

Defined results: null text: empty; no match: no spans; null and repeated ids give a row
each; empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, let

KINDS = ("email", "ip", "card", "phone", "loose_email", "loose_number")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "loose_email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "loose_number": r"\+?\(?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)*+",
}
# A text without this cannot hold a match.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
          "loose_email": r"@|[(\[]at[)\]]", "loose_number": "[0-9]{2}"}
_WORDS = {"about_mail": "mail", "about_phone": "phone|tel|call|fax|mobil", "about_card": "card|visa|iban|account|credit",
          "about_net": "ip|host|server|addr"}
FEATURES = ("is_email", "n_chars", "n_digits", "n_groups", "n_dots", "n_dashes", "n_blanks", "n_parens", "has_plus",
            "octets", "luhn", "is_date", "is_version", "ends_3_4", "ends_in_letters", "touches_left", "touches_right", *_WORDS)
DATE = r"^[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}$|^[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{2,4}$"
VERSION = r"^[0-9]{1,2}(\.[0-9]+){2,3}$"
MIN_DIGITS = 7  # of a loose number: the shortest telephone numbers
MIN_PRECISION = 0.95
CONTEXT = 24
_BIG = 1 << 62


def _candidates(text: Column) -> Column:
    """array<struct<kind, i, gap, match, before, after>> of all rules."""
    def of(k: int, name: str) -> Column:
        p = PATTERNS[name]
        has = F.contains(text, F.lit("@")) if name == "email" else F.rlike(text, F.lit(_NEEDS[name]))
        return F.when(has, let(F.split(text, p, -1), lambda pieces: F.transform(
            F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m, i: F.struct(
                F.lit(k).alias("kind"), i.alias("i"), F.length(F.get(pieces, i)).alias("gap"), m.alias("match"),
                F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("after"))))).otherwise(F.array())

    return F.concat(*[of(k, name) for k, name in enumerate(KINDS)])


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(rev, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    rev = F.reverse(digits)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _accepted(kind: Column, match: Column, digits: Column, n: Column) -> Column:
    """What a fixed rule asks of its match."""
    octets = F.forall(F.split(match, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (
        F.length(q) <= 3) & (F.coalesce(F.try_cast(q, "int") if hasattr(F, "try_cast") else q.try_cast("int"), F.lit(0)) <= 255)))
    return (F.when(kind == 0, True).when(kind == 1, octets)
            .when(kind == 2, F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
            .when(kind == 3, n.between(10, 15)).otherwise(False))


def candidate_rows(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(_rid, id) per document, and the candidates with position, verdict and features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = checkpoint(df.select(F.col(id_col).alias("_id"), text.alias("_text"))
                      .select("_id", _candidates(F.col("_text")).alias("c"))
                      .withColumn("_rid", F.monotonically_increasing_id()))
    place = Window.partitionBy("_rid", "kind").orderBy("i")
    rows = docs.select("_rid", F.inline("c")).withColumn("n_chars", F.length("match"))
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n_chars")).over(
        place.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("n_chars"))
    rows = rows.withColumn("digits", F.regexp_replace("match", "[^0-9]", "")).withColumn("n_digits", F.length("digits"))
    rows = rows.withColumn("accepted", _accepted(F.col("kind"), F.col("match"), F.col("digits"), F.col("n_digits")))
    loose = (F.col("kind") == 4) | ((F.col("kind") == 5) & (F.col("n_digits") >= MIN_DIGITS))
    return docs.select("_rid", "_id"), rows.where(F.col("accepted") | loose).select(
        "_rid", "kind", "start", "end", "accepted", "match", "before", "after")


def _described(rows: DataFrame) -> DataFrame:
    """Adds the features of ``match`` between ``before`` and ``after``."""
    kinds, match = F.col("kind"), F.col("match")
    rows = rows.withColumn("n_chars", F.length("match")).withColumn("digits", F.regexp_replace("match", "[^0-9]", "")) \
        .withColumn("n_digits", F.length("digits"))
    n_of = lambda c: F.length("match") - F.length(F.replace(match, F.lit(c), F.lit("")))
    around = F.lower(F.concat_ws(" ", "before", "after"))
    octets = F.when(match.rlike(PATTERNS["ip"]), 1).otherwise(0)
    return rows.withColumns({
        "is_email": kinds == 4, "n_groups": F.size(F.split(match, "[^0-9]+")), "n_dots": n_of("."), "n_dashes": n_of("-"),
        "n_blanks": n_of(" "), "n_parens": n_of("("), "has_plus": match.startswith("+"),
        "octets": octets, "luhn": F.when(F.col("n_digits").between(14, 19), _luhn(F.col("digits"))).otherwise(False),
        "is_date": match.rlike(DATE), "is_version": match.rlike(VERSION), "ends_3_4": match.rlike(r"[0-9]{3}[\x20).-]+[0-9]{4}$"),
        "ends_in_letters": match.rlike("[A-Za-z]{2}$"),
        "touches_left": F.rlike("before", F.lit("[A-Za-z0-9_@/.-]$")), "touches_right": F.rlike("after", F.lit("^[A-Za-z0-9_@/-]")),
        **{k: around.rlike(v) for k, v in _WORDS.items()}}).withColumns({f: F.col(f).cast("double") for f in FEATURES})


def _overlapping(rows: DataFrame) -> DataFrame:
    """Adds ``covered``: an accepted span overlaps this one. By sweeping each document's spans
    in order: the farthest end of accepted spans that start before, and the next start."""
    is_base = F.col("accepted")
    by = Window.partitionBy("_rid").orderBy("start", "end", "kind")
    return rows.withColumn("_far", F.max(F.when(is_base, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_next", F.min(F.when(is_base, F.col("start"))).over(by.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("covered", (F.coalesce("_far", F.lit(-1)) > F.col("start")) | (F.coalesce("_next", F.lit(_BIG)) < F.col("end"))) \
        .drop("_far", "_next")


def _examples(rows: DataFrame) -> DataFrame:
    """Labelled candidates (see the module): _rid, kind, match, before, after, label."""
    match, digits = F.col("match"), F.regexp_replace("match", "[^0-9]", "")
    before, after = F.col("before"), F.col("after")
    of = lambda kind, text, label, b=before, a=after: F.struct(
        F.lit(kind).alias("kind"), text.alias("match"), b.alias("before"), a.alias("after"), F.lit(label).alias("label"))
    national = F.regexp_replace(match, r"^\+[0-9]{1,3}[\x20.-]*(?=.*[0-9]{3})", "")
    grouped = lambda by: F.btrim(F.regexp_replace(national, "[^0-9]+", by), F.lit(by))
    phones = [F.regexp_replace(match, r"^\+", ""), national, grouped("."), grouped("-"), grouped(" ")]
    cards = [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", by) for by in ("$1.", "$1 - ")]
    name, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    spelled = lambda d: F.replace(host, F.lit("."), F.lit(d))
    mails = [F.concat(name, F.lit(at), h) for at, h in (
        ("(at)", host), (" (at) ", host), ("[at]", host), (" @ ", host), ("(at)", spelled("(dot)")), (" [at] ", spelled(" [dot] ")))]
    d = lambda i, n: F.substring(digits, i, n)
    made = [of(5, digits, 0.0, F.lit("order no "), F.lit(" of ")), of(5, F.concat_ws("-", d(1, 4), d(5, 2), d(7, 2)), 0.0),
            of(5, F.concat_ws(".", d(1, 2), d(3, 2), d(5, 4)), 0.0)]
    price = F.concat(F.length(match).cast("string"), F.lit(" @ 3."), F.length(name).cast("string"))
    kind = F.col("kind")
    rewritten = F.when(kind == 0, F.array(*[of(4, m, 1.0) for m in mails], of(4, price, 0.0))) \
        .when(kind == 2, F.array(*[of(5, m, 1.0) for m in cards], *made)) \
        .when(kind == 3, F.array(*[of(5, m, 1.0) for m in phones], *made))
    out = rows.where(F.col("accepted") & kind.isin(0, 2, 3)).select("_rid", F.explode(rewritten).alias("x")).select("_rid", "x.*")
    plain = F.regexp_replace("match", "[^0-9]", "") == match
    out = out.where((F.col("label") == 0.0) | (kind == 4) | (~plain & (F.length(digits) >= MIN_DIGITS)))
    ordinary = match.rlike(DATE) | match.rlike(VERSION) | (plain & ~F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False))
    found = rows.where((kind == 5) & ~F.col("covered") & ordinary | (kind == 4) & ~F.col("covered") & ~match.rlike("[A-Za-z]{2}$"))
    return out.unionByName(found.select("_rid", "kind", "match", "before", "after", F.lit(0.0).alias("label")))


def _scored(rows: DataFrame, min_precision: float) -> DataFrame:
    """The loose candidates that the calibrated model selects and that no fixed span covers."""
    loose = rows.where((F.col("kind") >= 4) & ~F.col("covered"))
    examples = _examples(rows)
    total, good = examples.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not good or good == total:
        return loose.where("false")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_f")
    examples = checkpoint(assembler.transform(_described(examples)).select(
        "kind", "_f", "label", (F.pmod(F.xxhash64("_rid"), F.lit(3)) == 0).alias("held")))
    labels = examples.where(~F.col("held")).agg(F.sum("label"), F.count(F.lit(1))).first()
    if not labels[1] or labels[0] in (None, 0.0, float(labels[1])):
        return loose.where("false")
    model = GBTClassifier(featuresCol="_f", labelCol="label", maxIter=8, maxDepth=3, stepSize=0.3, minInstancesPerNode=10, seed=1,
                          cacheNodeIds=False).fit(examples.where(~F.col("held")).drop("held"))
    score = lambda d: model.transform(d).withColumn("_p", F.floor(vector_to_array("probability")[1] * 100).cast("int"))
    bins = score(examples.where("held")).groupBy("kind", "_p").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()
    enough = F.lit(False)
    for kind in (4, 5):
        n = hit = 0.0
        mine = [r for r in bins if r["kind"] == kind]
        low = 50 if mine else 90  # per cent
        for r in sorted((r for r in mine if r["_p"] >= low), key=lambda r: -r["_p"]):
            if hit + r["good"] < min_precision * (n + r["n"]):
                low = r["_p"] + 1
                break
            n, hit = n + r["n"], hit + r["good"]
        enough = enough | ((F.col("kind") == kind) & (F.col("_p") >= low))
    return score(assembler.transform(_described(loose))).where(enough).select(*loose.columns)


def pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        min_precision: float = MIN_PRECISION) -> DataFrame:
    """Per row: id, spans array<struct<start, k, end, kind>> in code points, by start, then kind
    as in ``KINDS``; the first four kinds are the fixed rules'."""
    docs, rows = candidate_rows(df, id_col, text_col)
    rows = checkpoint(_overlapping(rows))
    added = _scored(rows, min_precision)
    chosen = rows.where("accepted").unionByName(added)
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = chosen.groupBy(F.col("_rid").alias("_r")).agg(F.array_sort(F.collect_list(F.struct(
        "start", F.col("kind").alias("k"), "end", F.get(names, F.col("kind")).alias("kind")))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return docs.join(spans, F.col("_rid") == F.col("_r"), "left").select(
        F.col("_id").alias(id_col), F.coalesce("spans", empty).alias("spans"))
