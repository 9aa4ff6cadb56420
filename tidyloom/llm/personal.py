"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers.

Only DataFrame functions run on executors. Candidates are the base forms and
looser ones (numbers without a country code, written-out addresses). Regex,
checksum, gazetteer and context labelers vote for, against or abstain. The
counts of vote patterns are a table of bounded size; expectation-maximisation
on it gives each labeler's reliability and each pattern's probability, and
those train a naive Bayes classifier over features of the span, which decides
about the candidates that have no base form.
"""

from __future__ import annotations

from math import exp, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.llm.store import saved

KINDS = ("email", "ip", "card", "phone")

# Possessive runs and look-behinds match as the plain forms do, but never go back over a long run:
# a match starts where a run starts, or where the match before has ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}+){1,4}",
    "phone": r"(?<![0-9+().-])(?<![0-9+().-] )(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])(?![ .-][0-9])",
}
#: Texts without any of these have no candidate.
_SIGNS = ("@", "+", "(at)", "[at]")
_SIGN_FORMS = (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9]{3}(?:\) ?|[.-])[0-9]{3}[ .-][0-9]{4}")

# Gazetteers and cue words.
TOP_DOMAINS = "com org net edu gov io info biz eu uk de fr es it nl us ca".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420".split()
ISSUER_PREFIXES = "4 51 52 53 54 55 34 37 6011 65 35 2".split()
CUES = {
    "email": r"(?i)(mail|contact|write|reach|correo|courriel|adresse|address)",
    "ip": r"(?i)(ip|host|server|address|addr|client|login|remote)",
    "card": r"(?i)(card|visa|master|amex|credit|debit|carte|karte|tarjeta|pay)",
    "phone": r"(?i)(tel|phone|call|fax|mobile|cell|handy|whatsapp|sms|dial)",
}
ANTI_CUES = r"(?i)(version|isbn|issn|order|invoice|serial|release|chapter|section|figure|build)"
LABELERS = ("form", "check", "gazetteer", "context", "edges")
_CONTEXT = 40


def _candidates(texts: DataFrame, kind: str, pattern: str, base: bool) -> DataFrame:
    """Every match: row, number, length of the gap before it, the match, and text around it."""
    hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    listed = texts.select("row", hits.alias("hits"), F.split("text", pattern, -1).alias("gaps"), "text")
    each = listed.select("row", F.posexplode(F.arrays_zip("hits", F.slice(F.col("gaps"), F.lit(1), F.size("hits")).alias("gap"), F.slice(F.col("gaps"), F.lit(2), F.size("hits")).alias("next"))).alias("i", "m"))
    return each.select(
        "row",
        F.lit(kind).alias("kind"),
        F.lit(base).alias("base"),
        "i",
        F.length("m.gap").cast("long").alias("gap"),
        F.col("m.hits").alias("value"),
        F.right("m.gap", F.lit(_CONTEXT)).alias("before"),
        F.left("m.next", F.lit(_CONTEXT)).alias("after"),
    )


def _digits(column: str = "value") -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a number passes the card check: every second digit from the right counts twice."""

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = (F.length(digits) - i) % 2 == 1
        return total + F.when(doubled & (digit > 4), 2 * digit - 9).when(doubled, 2 * digit).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _holds() -> Column:
    """Whether a match has what its kind asks for beyond the form."""
    digits = _digits()
    parts = F.split("value", r"\.")
    small = F.forall(parts, lambda part: F.length(F.regexp_replace(part, "^0+", "")) <= 3) & F.forall(
        parts, lambda part: F.coalesce(F.substring(F.regexp_replace(part, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255
    )
    card = F.length(digits).between(14, 19)
    return (
        F.when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", F.when(card, _luhn(digits)).otherwise(F.lit(False)))
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15))
        .otherwise(F.lit(True))
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _votes() -> list[Column]:
    """One column for each labeler: 1 for, -1 against, 0 no opinion."""
    kind, value, never = F.col("kind"), F.col("value"), F.lit(False)
    digits = _digits()
    domain = F.lower(F.regexp_extract("value", r"([A-Za-z]+)[^A-Za-z]*$", 1))
    code = [F.col("base") & digits.startswith(c) for c in COUNTRY_CODES]
    issuer = [digits.startswith(c) for c in ISSUER_PREFIXES]
    reserved = F.regexp_like("value", F.lit(r"^0*(0|127|10)\.|^192\.168\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    cue = F.lit(False)
    for name in KINDS:
        cue = cue | ((kind == name) & F.regexp_like("before", F.lit(CUES[name])))
    listed = (
        F.when(kind == "email", domain.isin(TOP_DOMAINS))
        .when(kind == "phone", _any(code))
        .when(kind == "card", _any(issuer))
        .otherwise(never)
    )
    refuted = F.when(kind == "ip", reserved).when(kind == "card", ~_any(issuer)).otherwise(never)
    glued = F.regexp_like("before", F.lit(r"[A-Za-z0-9_]$")) | F.regexp_like("after", F.lit(r"^(?:[A-Za-z0-9_]|[.-][0-9])"))
    return [
        _vote(F.col("base"), never).alias("form"),
        _vote(F.col("holds") & (kind != "email"), ~F.col("holds") | F.regexp_like("value", F.lit(r"^(.)\1*$"))).alias("check"),
        _vote(listed, refuted).alias("gazetteer"),
        _vote(cue, F.regexp_like("before", F.lit(ANTI_CUES))).alias("context"),
        _vote(~glued, glued).alias("edges"),
    ]


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def reliabilities(patterns: list[tuple], rounds: int = 100, prior: float = 0.5) -> tuple[dict[tuple, float], dict]:
    """Expectation-maximisation over counted vote patterns ``(kind, votes, count)``.

    Two classes for each kind; a labeler votes independently given the class.
    Gives the probability of being personal data for each pattern, and for
    each kind the share and each labeler's vote rates by class. There are at
    most 4 * 3**5 patterns, whatever the input.
    """
    posterior, learned = {}, {}
    for kind in sorted({p[0] for p in patterns}):
        rows = [(votes, n) for k, votes, n in patterns if k == kind]
        share = prior
        # Labelers are better than chance to begin with.
        rates = [{True: {1: 0.6, 0: 0.3, -1: 0.1}, False: {1: 0.1, 0: 0.3, -1: 0.6}} for _ in LABELERS]
        for _ in range(rounds):
            weighed = []
            for votes, n in rows:
                yes, no = log(share), log(1 - share)
                for rate, vote in zip(rates, votes):
                    yes, no = yes + log(rate[True][vote]), no + log(rate[False][vote])
                weighed.append((votes, n, 1 / (1 + exp(max(-700.0, min(700.0, no - yes))))))
            total = sum(n for _, n, _ in weighed)
            positive = sum(n * p for _, n, p in weighed)
            share = min(0.999, max(0.001, (positive + 1) / (total + 2)))
            for i in range(len(LABELERS)):
                for side, of in ((True, positive), (False, total - positive)):
                    for vote in (1, 0, -1):
                        got = sum(n * (p if side else 1 - p) for votes, n, p in weighed if votes[i] == vote)
                        start = {1: 0.6, 0: 0.3, -1: 0.1}[vote if side else -vote]
                        rates[i][side][vote] = (got + 10 * start) / (of + 10)  # ten assumed votes keep the classes apart
        posterior.update({(kind, *votes): p for votes, _, p in weighed})
        learned[kind] = {"share": share, "rates": dict(zip(LABELERS, rates))}
    return posterior, learned


def _features() -> Column:
    """What the span classifier sees: votes, length, shape and words around the span, as bounded labels."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a"), "[^9Aa]+", "-")
    last = F.lower(F.regexp_extract("before", r"([A-Za-z]+)[^A-Za-z]*$", 1))
    return F.array(
        *(F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in LABELERS),
        F.concat(F.lit("length="), F.least(F.lit(40), F.length("value")).cast("string")),
        F.concat(F.lit("shape="), F.pmod(F.xxhash64(shape), F.lit(256)).cast("string")),
        F.concat(F.lit("word="), F.pmod(F.xxhash64(last), F.lit(256)).cast("string")),
    )


_SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean,value:string,p:double>>"


def personal_spans(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: str | None = None) -> DataFrame:
    """The id, ``spans`` and the column ``carry`` for every row. Spans are an array of start, rank, kind, end, base, value and probability, by start and kind.

    Offsets count code points, the end is exclusive. Base spans are the
    leftmost matches that do not overlap within their kind and pass the kind's
    check; they are always kept. Other candidates are kept where the trained
    classifier gives them one half or more and no base span overlaps them.

    Defined cases: null and empty texts have no spans; repeated rows, and rows
    without an id, each get their own; with no candidate at all nothing is
    trained and every array is empty. Other columns are ignored.
    """
    spark = documents.sparkSession
    text = F.col(text_column)
    sign = _any([text.contains(s) for s in _SIGNS] + [text.rlike(f) for f in _SIGN_FORMS])
    carried = [F.col(carry).alias("carried")] if carry else []
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), *carried, F.when(sign, text).alias("text"))
    rows = saved(rows, "texts")
    texts = rows.where(F.col("text").isNotNull()).select("row", "text")
    found = None
    for base, forms in ((True, BASE), (False, LOOSE)):
        for kind, pattern in forms.items():
            part = _candidates(texts, kind, pattern, base)
            found = part if found is None else found.unionByName(part)
    before = Window.partitionBy("row", "kind", "base").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    placed = found.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).withColumn("holds", _holds())
    # A base form that fails its check is dropped; it stays as a candidate only where the classifier may know better: never.
    placed = placed.where(F.col("holds") | ~F.col("base"))
    voted = saved(placed.select("row", "kind", "base", "start", "end", "value", "before", *_votes()), "votes")
    patterns = voted.groupBy("kind", *LABELERS).count().collect()  # at most 4 * 3**5 rows
    posterior, _ = reliabilities([(r["kind"], tuple(r[n] for n in LABELERS), r["count"]) for r in patterns])
    keys = ["kind", *LABELERS]
    # As an Arrow table: rows in Python would start Python processes on the executors, which stay beside those of the next stages.
    columns = [*zip(*((*k, float(p)) for k, p in posterior.items()))] or [()] * (len(keys) + 1)
    kinds = [pa.string(), *(pa.int32() for _ in LABELERS), pa.float64()]
    known = spark.createDataFrame(pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[*keys, "p"]))
    weighed = voted.join(F.broadcast(known), keys).withColumn("features", _features())
    # Naive Bayes: how often each feature goes with either class, the probabilities as weights. At most 4 * 600 rows.
    each = weighed.select("kind", "p", F.explode("features").alias("feature"))
    weights = each.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    totals = weighed.groupBy("kind").agg(F.sum("p").alias("all_yes"), F.sum(1 - F.col("p")).alias("all_no"))
    weights = weights.join(F.broadcast(totals), "kind").select(
        "kind", "feature", (F.log((F.col("yes") + 1) / (F.col("all_yes") + 2)) - F.log((F.col("no") + 1) / (F.col("all_no") + 2))).alias("w")
    )
    weights = saved(weights, "weights")
    odds = totals.select("kind", F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("odds"))
    loose = weighed.where(~F.col("base")).select("row", "kind", "start", "end", "value", F.explode("features").alias("feature"))
    judged = loose.join(F.broadcast(weights), ["kind", "feature"]).groupBy("row", "kind", "start", "end", "value").agg(F.sum("w").alias("w"))
    judged = judged.join(F.broadcast(odds), "kind").withColumn("p", 1 / (1 + F.exp(F.greatest(F.lit(-35.0), F.least(F.lit(35.0), -(F.col("w") + F.col("odds")))))))
    added = judged.where("p >= 0.5").select("row", "kind", F.lit(False).alias("base"), "start", "end", "value", "p")
    spans = weighed.where("base").select("row", "kind", "base", "start", "end", "value", "p").unionByName(added)
    earlier = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "base")
    last = F.max(F.when(F.col("base"), F.col("end"))).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(earlier.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(last, F.lit(0)) <= F.col("start")) & (F.coalesce(following, F.col("end")) >= F.col("end"))
    spans = spans.withColumn("free", F.col("base") | free).where("free")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "base", "value", "p"))).alias("spans"))
    out = rows.drop("text").join(listed, "row", "left")
    return out.select(F.col("id").alias(id_column), *(F.col("carried").alias(carry) for _ in carried), F.coalesce("spans", F.array().cast(_SPAN)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first names the place.

    Spans are in order, so each place between them is copied once.
    """
    ends = F.transform(spans, lambda s, i: F.array_max(F.transform(F.slice(spans, F.lit(1), i + 1), lambda t: t["end"])))
    begins = F.concat(F.array(F.lit(0).cast("long")), ends)
    stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    names = F.concat(F.transform(spans, lambda s: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))), F.array(F.lit("")))
    covered = F.concat(F.transform(spans, lambda s, i: (i > 0) & (s["start"] < F.try_element_at(begins, i + 1))), F.array(F.lit(False)))
    parts = F.transform(
        F.arrays_zip(begins.alias("a"), stops.alias("b"), names.alias("n"), covered.alias("c")),
        lambda z: F.concat(F.substring(text, (z["a"] + 1).cast("int"), F.greatest(F.lit(0), z["b"] - z["a"]).cast("int")), F.when(z["c"], F.lit("")).otherwise(z["n"])),
    )
    return F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(text)
