r"""Personal data: pattern spans, and further ones that gradient boosted trees accept.

Four kinds have a strict pattern and a check (the base): e-mail address, IPv4
address, payment card, phone number. For each kind a second, wider pattern proposes
candidates with high recall: other separators, spelled-out signs, no plus sign,
ports. Candidates overlap each other and the base. Boosted trees learn from
surroundings and rough format: right are candidates that touch a base match of their
kind, wrong are those in surroundings, or of a rough format, in which the whole corpus has
no base match of the kind. The features leave out what tells a base match from another candidate (plus,
points, at sign, number of digits, sizes of numbers). A candidate in surroundings and
of a format that base matches have is neither right nor wrong; it is to be decided. The trees
are fitted to a bounded sample, drawn by kind and label; all other labelled candidates
are counted by kind and score, and the kind's threshold is the lowest score from which on
they are right as often as wanted and which nearly all base matches of the kind reach
(both by ``precision``). Undecided candidates that reach it, pass the check and touch no
base span are added, of overlapping ones the best.

Secrets (long strings behind a word like token or password and a sign) are told by one
pattern and listed apart; they are no span of the four kinds.

All of this is DataFrame and SQL functions. Matches keep Java's order, leftmost and
not overlapping; possessive quantifiers and the look behind say what the plain
patterns say without trying a long run again from each of its characters. Places
are code points: lengths of what lies between the matches, added up by a window
over the matches of one text and pattern. Equal texts are searched alike and their
matches kept once.

Null and empty texts have no spans. Without candidates, or with candidates of one
sort only, nothing is learned and the base alone is returned. Repeated rows get equal
results; an empty table gives an empty one; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threatlens.session import materialize

KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3}+(?::[0-9]{1,5}+)?",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]{0,2}+[0-9]){11,22}+",
    "phone": r"(?<![0-9+])(?:\+|00)?\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+",
}
# What a text must hold before a pattern is tried, where that is cheap to see.
HINTS = {"email": "@", "phone": "+"}
BEFORE, AFTER = 32, 12
# About so many candidates are fitted, in equal parts by kind and label; thresholds count all others.
SAMPLE = 20_000
FITTED = 0.75
PRECISION = 0.97
SECRET = r"""(?i)(?<![a-z0-9+/_-])(?=[a-z0-9+/_-]{16})(?<=(?:token|password|passwd|secret|api.?key)["']?\x20?[=:]\x20?["']?)[a-z0-9+/_-]++"""
WORDS = {
    "says_phone": r"(?i)(?:phone|tel|call|fax|mobile)", "says_mail": r"(?i)(?:mail|contact|write)",
    "says_card": r"(?i)(?:card|visa|pay|credit)", "says_ip": r"(?i)(?:\bip\b|host|server|addr)", "says_secret": r"(?i)(?:token|password|key|secret)",
}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes(kind: Column, match: Column) -> Column:
    """The check behind a base pattern."""
    number = digits(match)

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))

    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(F.split(match, r"\."), small))
        .when(kind == "card", F.length(number).between(13, 19) & F.call_function("luhn_check", number))
        .otherwise(F.length(number).between(9, 15))
    )


def text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def all_matches(docs: DataFrame, text: str) -> DataFrame:
    """``tk, kind, base, start, end, match, before, after`` of every match of every pattern in every text."""
    patterns = [(kind, True, BASE[kind]) for kind in KINDS] + [(kind, False, WIDE[kind]) for kind in KINDS] + [("secret", True, SECRET)]
    rows = docs.select(text_key(F.col(text)).alias("tk"), F.col(text).alias("_text")).filter("_text IS NOT NULL")
    found = {}
    for i, (kind, base, pattern) in enumerate(patterns):
        matches = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        found[f"_m{i}"] = F.when(F.contains("_text", F.lit(HINTS[kind])), matches) if base and kind in HINTS else matches
    rows = rows.select("*", *[c.alias(n) for n, c in found.items()])
    each = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("base"), F.col(f"_m{i}").alias("matches"),
            F.when(F.size(f"_m{i}") > 0, F.split("_text", pattern, -1)).alias("pieces"),
        )
        for i, (kind, base, pattern) in enumerate(patterns)
    ]
    searched = rows.select("tk", F.explode(F.filter(F.array(*each), lambda x: F.size(x["matches"]) > 0)).alias("f"))

    def piece(match: Column, i: Column) -> Column:
        left, right = F.get("f.pieces", i), F.get("f.pieces", i + 1)
        return F.struct(
            i.alias("n"), F.length(left).cast("long").alias("gap"), match.alias("match"),
            F.right(left, F.lit(BEFORE)).alias("before"), F.left(right, F.lit(AFTER)).alias("after"),
        )

    # Kind and base leave the struct first: else all matches of the text would go along with each of them.
    matched = searched.select("tk", "f.kind", "f.base", F.transform("f.matches", piece).alias("all"))
    one = matched.select("tk", "kind", "base", F.explode("all").alias("p")).select("tk", "kind", "base", "p.*")
    until = W.partitionBy("tk", "kind", "base").orderBy("n")
    size = F.length("match").cast("long")
    end = F.sum(F.col("gap") + size).over(until)
    return one.dropDuplicates(["tk", "kind", "base", "n"]).withColumn("end", end).withColumn("start", F.col("end") - size)


def features(candidates: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each candidate as numbers."""
    m, number = F.col("match"), digits(F.col("match"))
    groups = F.filter(F.split(F.regexp_replace(m, "[^0-9]+", " "), " "), lambda g: g != "")
    numeric = F.col("kind").isin("card", "phone")
    values = {
        "kind_number": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")),
        "groups": F.when(numeric, F.least(F.size(groups), F.lit(3))).otherwise(0),
        "longest_group": F.when(numeric, F.least(F.array_max(F.transform(groups, F.length)), F.lit(6))).otherwise(0),
        "first_digit": F.when(F.col("kind") == "card", F.left(number, F.lit(1)).try_cast("int")).otherwise(0),
        "letter_before": F.col("before").rlike("[A-Za-z0-9_]$").cast("int"), "letter_after": F.col("after").rlike("^[A-Za-z0-9_]").cast("int"),
        "sign_before": F.col("before").rlike("""[=:"'/#]\\s*$""").cast("int"), "sign_after": F.col("after").rlike("""^[="'/%]""").cast("int"),
    } | {name: F.col("before").rlike(pattern).cast("int") for name, pattern in WORDS.items()}
    return candidates.withColumns({n: c.cast("double") for n, c in values.items()}), list(values)


FORMAT = ["groups", "longest_group", "first_digit"]
CONTEXT = ["letter_before", "letter_after", "sign_before", "sign_after", *WORDS]


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def meets_base(keys: list[str]) -> Column:
    """Whether a span overlaps a base span with the same keys. The spans of one text pass once in each
    direction: one that begins before must end after, one that begins later must begin inside."""
    is_base = F.col("base")
    before = W.partitionBy(*keys).orderBy("start").rangeBetween(W.unboundedPreceding, -1)
    behind = W.partitionBy(*keys).orderBy(F.col("start").desc()).rangeBetween(W.unboundedPreceding, 0)
    reaches = F.coalesce(F.max(F.when(is_base, F.col("end"))).over(before) > F.col("start"), F.lit(False))
    begins = F.coalesce(F.min(F.when(is_base, F.col("start"))).over(behind) < F.col("end"), F.lit(False))
    return reaches | begins


def thresholds(scored: DataFrame, precision: float) -> dict[str, float]:
    """For each kind the lowest score, to three places, from which on labelled rows are right often enough
    and which nearly all right ones reach.

    One aggregate of at most 1,001 rows a kind over all of ``scored``, whatever its size.
    """
    counts = (
        scored.groupBy("kind", F.floor(F.col("score") * 1000).cast("int").alias("step"))
        .agg(F.sum("label").alias("right"), F.sum(1 - F.col("label")).alias("wrong")).collect()
    )
    out = {}
    for kind in KINDS:
        rows = sorted((r for r in counts if r.kind == kind), key=lambda r: -r.step)
        every, right, wrong = sum(r.right for r in rows), 0, 0
        for row in rows:
            reached = right >= precision * every
            right, wrong = right + row.right, wrong + row.wrong
            if right and right >= precision * (right + wrong) and not reached:
                out[kind] = row.step / 1000
    return out


def apart(spans: DataFrame) -> DataFrame:
    """``tk, added``: of spans that overlap the best ones, by score, then length, then kind."""
    # Runs of spans that touch the one before; a text is cut into many small ones.
    place = W.partitionBy("tk").orderBy("start", "end", "number")
    so_far = F.max("end").over(place.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(F.col("start") < F.coalesce(so_far, F.lit(-1)), 0).otherwise(1)
    runs = spans.withColumn("begins", begins).withColumn("run", F.sum("begins").over(place.rowsBetween(W.unboundedPreceding, 0)))
    each = runs.groupBy("tk", "run").agg(F.collect_list(F.struct("number", "start", "end", "kind", "score")).alias("good"))

    def better(a: Column, b: Column) -> Column:
        def rank(x: Column) -> Column:
            return F.struct(x["score"], x["end"] - x["start"], -x["number"], -x["start"])

        return rank(a) > rank(b)

    best = F.filter("good", lambda a: ~F.exists("good", lambda b: overlap(a, b) & better(b, a)))
    return each.select("tk", F.explode(best).alias("s")).groupBy("tk").agg(F.array_sort(F.collect_list("s")).alias("added"))


def find_spans(docs: DataFrame, text: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """``tk, base, added, secrets``: for each different text with spans, lists of kind number, kind, start, end and score."""
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    stored = materialize(all_matches(docs, text).withColumn("number", number), "matches")
    secrets = stored.filter(F.col("kind") == "secret").groupBy("tk").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("secrets"))
    spans = stored.filter((F.col("kind") != "secret") & (~F.col("base") | passes(F.col("kind"), F.col("match"))))
    base = spans.filter("base").groupBy("tk").agg(F.array_sort(F.collect_list(F.struct("number", "start", "end", "kind"))).alias("base"))
    wide = (
        spans.withColumn("own", meets_base(["tk", "number"])).withColumn("touched", meets_base(["tk"])).filter(~F.col("base")).drop("base")
        .withColumn("free", ~F.col("touched") & ((F.col("kind") == "phone") | passes(F.col("kind"), F.regexp_replace("match", ":[0-9]+$", ""))))
    )
    described, names = features(wide)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(described.withColumns({"context": F.concat_ws(",", *CONTEXT), "format": F.concat_ws(",", *FORMAT)}))
    assembled = materialize(vectors.drop(*names), "candidates")
    # At most four kinds by two to the number of signs, and by a few hundred formats.
    for name in ("context", "format"):
        known = assembled.groupBy("kind", name).agg(F.max(F.col("own").cast("int")).alias(f"{name}_holds"))
        assembled = assembled.join(F.broadcast(known), ["kind", name])
    strange = (F.col("context_holds") == 0) | (F.col("format_holds") == 0)
    labelled = assembled.withColumn("label", F.when(F.col("own"), 1.0).when(strange, 0.0))
    added = apart(_accepted(labelled, sample, precision))
    found = base.join(added, "tk", "full_outer").join(secrets, "tk", "full_outer")
    return found


def _accepted(candidates: DataFrame, sample: int, precision: float) -> DataFrame:
    """The undecided candidates that the trees accept; none if there is only one label to learn from."""
    told = candidates.filter(F.col("label").isNotNull())
    totals = {(r.kind, r.label): r["count"] for r in told.groupBy("kind", "label").count().collect()}
    none = candidates.filter(F.lit(False)).withColumn("score", F.lit(0.0))
    if {label for _, label in totals} != {0.0, 1.0}:
        return none
    # A hash decides who is fitted, so a rerun fits the same trees; weights restore each kind's own shares.
    shares = {k: min(FITTED, sample / (2 * len(KINDS)) / n) for k, n in totals.items()}
    of_kind = {kind: sum(n * shares[k, y] for (k, y), n in totals.items() if k == kind) / sum(n for (k, _), n in totals.items() if k == kind) for kind, _ in totals}

    def by_stratum(values: dict) -> Column:
        return F.coalesce(*[F.when((F.col("kind") == kind) & (F.col("label") == label), F.lit(float(v))) for (kind, label), v in values.items()])

    place = F.pmod(F.xxhash64("tk", "kind", "start"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    fitted = place < by_stratum(shares)
    weight = by_stratum({k: of_kind[k[0]] / share for k, share in shares.items()}).alias("weight")
    known = materialize(told.filter(fitted).orderBy("tk", "kind", "start").select("label", "features", weight), "candidate-sample")
    if known.select("label").distinct().count() < 2:
        return none
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7, checkpointInterval=-1, weightCol="weight")
    model = trees.fit(known.coalesce(1))

    def scored(rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumn("score", vector_to_array("probability")[1])

    least = thresholds(scored(told.filter(~fitted)), precision)
    limit = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(t)) for kind, t in least.items()], F.lit(2.0))
    return scored(candidates.filter(F.col("free") & F.col("label").isNull())).filter(F.col("score") >= limit)


def personal_data(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``base`` and ``added`` spans, both in the order of kind and start, and ``secrets``."""
    spans = find_spans(docs.select(text), text, **options)
    key = "tk" + "_" * max([len(c) for c in docs.columns], default=0)
    rows = docs.drop("base", "added", "secrets").withColumn(key, text_key(F.col(text)))
    kinds = {n: spans.schema[n].dataType for n in ("base", "added", "secrets")}
    joined = rows.join(spans.withColumnRenamed("tk", key), key, "left").drop(key)
    return joined.withColumns({n: F.coalesce(n, F.array().cast(kind)) for n, kind in kinds.items()})


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the text's spans replaced by their kind in brackets."""
    found = personal_data(docs.withColumns({f"_kept_{c}": F.col(c) for c in docs.columns}), text, **options)
    secret = F.transform("secrets", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("secret").alias("kind")))
    spans = F.array_sort(F.concat(F.transform("base", _place), F.transform("added", _place), secret))

    def cut(state: Column, s: Column) -> Column:
        return F.struct(
            F.concat(state["out"], F.substr(F.col(f"_kept_{text}"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0))), F.when(s["start"] >= state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    whole = F.aggregate(spans, start, cut, lambda state: F.concat(state["out"], F.substr(F.col(f"_kept_{text}"), state["at"] + 1)))
    return found.select(*[whole.alias(c) if c == text else F.col(f"_kept_{c}").alias(c) for c in docs.columns])


def _place(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
