"""Personal data: regex, gazetteer and context labelers vote, expectation-maximisation weighs them, and a
classifier of spans is trained on what comes out. Column expressions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import spare_name, staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "check", "gazetteer", "words", "edge")
THRESHOLD = 0.5
#: Characters before and behind a span that the context labelers read.
BEFORE, BEHIND = 48, 24
#: Lengths from which on a span counts as longer; pieces whose lengths are added up at once.
LONGER = (12, 20, 32)
_STEP = 128
_CUT, _NO_CUT = "\x01", "\x02"
#: Expectation-maximisation: rounds, and the labelled spans that a labeler's assumed reliability counts for.
ROUNDS, ASSUMED, RELIABILITY = 40, 8.0, 0.8

# What a span is. The first pattern of a kind is the plain form, written so that the
# search never goes back over a run; the second is what the labelers may add: written around, grouped
# or separated otherwise.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_AT, _DOT = r"[\[({] {0,2}(?i:at) {0,2}[\])}]", r"[\[({] {0,2}(?i:dot) {0,2}[\])}]"
_SIGN = r"(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))"
PATTERNS = {
    "email": (
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        rf"(?<![A-Za-z0-9._%+@-]){_LOCAL}++ {{0,2}}(?:@|{_AT}) {{0,2}}{_LABEL}++(?: {{0,2}}{_DOT} {{0,2}}{_LABEL}++|\.{_LABEL}++)++(?!{_LOCAL}*+@)",
    ),
    "ip": (
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        rf"(?<![0-9.\])])[0-9]{{1,3}}(?:{_SIGN}[0-9]{{1,3}}){{3}}(?![.\[(]?[0-9])"
        r"|(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])"
        r"|(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:.])",
    ),
    "card": (
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
        r"(?<![0-9])(?<![0-9][ ./_-])[0-9]{4}([./_]|  | - )[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![ ./_-]?[0-9])",
    ),
    "phone": (
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"(?<![0-9A-Za-z+,/@_-])(?<![0-9][ .-])(?:00[1-9][0-9]{0,2}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])"
        r"[0-9]{3,4}[ .-][0-9]{3,4}(?![ .,-]?[0-9]|[A-Za-z_@/])",
    ),
}

# Gazetteers and the words that speak for or against a kind.
TOP_LEVELS = (
    "com org net edu gov mil int info biz name io co me dev app ai eu us uk ca au nz ie de fr es it nl be ch at se no dk fi "
    "pl cz pt gr ru ua tr jp cn kr in br mx ar cl za"
).split()
_ISSUER = "^(?:4|5[1-5]|2[2-7]|3[0-9]|6(?:011|2|4[4-9]|5))"
_CALLING = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
CUES = {
    "email": ("e-?mail|mail|contact|write|reach|send|address|correo|courriel|kontakt", "package|import|commit|decorator"),
    "ip": ("ip|host|addr|address|server|client|login|from|ping|ssh|peer|remote", "version|release|section|chapter|build|firmware"),
    "card": ("card|visa|mastercard|amex|credit|debit|payment|pay|tarjeta|carte|karte", "isbn|order|invoice|tracking|sku|serial|id|ean|imei|hash"),
    "phone": (
        "tel|phone|telephone|call|mobile|cell|fax|whatsapp|dial|ring|contact|telefono|telefon",
        "order|invoice|isbn|id|serial|part|model|ref|tracking|date|score|sku",
    ),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, n: a + n)


def _places(pieces: Column) -> Column:
    """Every second piece, the matches: its number ``i``, ``start`` in characters, length ``n``.

    Lengths are added up block by block, so a text of very many matches costs little more than its length.
    """

    def in_blocks(blocks: Column) -> Column:
        def with_totals(totals: Column) -> Column:
            def in_block(sizes: Column, block: Column) -> Column:
                return _let(
                    _sum(F.slice(totals, F.lit(1), block)),
                    lambda before: F.transform(
                        F.filter(F.sequence(F.lit(0), F.size(sizes) - 1), lambda i: i % 2 == 1),
                        lambda i: F.struct(
                            (block * _STEP + i).alias("i"),
                            (before + _sum(F.slice(sizes, F.lit(1), i))).alias("start"),
                            F.get(sizes, i).alias("n"),
                        ),
                    ),
                )

            return F.flatten(F.transform(blocks, in_block))

        return _let(F.transform(blocks, _sum), with_totals)

    def cut(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / _STEP).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * _STEP + 1, F.lit(_STEP))), in_blocks)

    return _let(F.transform(pieces, lambda p: F.length(p).cast("long")), cut)


def _vote(yes: Column, no: Column) -> Column:
    """1, 0, or -1 where a labeler has nothing to say."""
    return F.when(yes, 1).when(no, 0).otherwise(-1).cast("tinyint")


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _words(words: str) -> str:
    return rf"(?i)(?<![a-z])(?:{words})(?![a-z])"


def _judged(kind: str, span: Column, before: Column, behind: Column) -> tuple[Column, Column, dict[str, Column]]:
    """Whether a match is one of the plain ones, whether it is a candidate at all, and the votes."""
    digits = F.regexp_replace(span, "[^0-9]", "")
    true, false = F.lit(True), F.lit(False)
    if kind == "email":
        plain = ~span.rlike(r"[ \[\](){}]")
        last = F.lower(F.element_at(F.split(span, "[^A-Za-z0-9-]+"), -1))
        candidate, check, no_check = true, last.rlike("^[a-z]{2,24}$"), ~last.rlike("^[a-z]{2,24}$")
        known, unknown = last.isin(*TOP_LEVELS), ~last.isin(*TOP_LEVELS)
    elif kind == "ip":
        plain, six = span.rlike("^[0-9.]+$"), span.contains(":")
        parts = F.transform(F.filter(F.split(span, "[^0-9]+"), lambda p: p != ""), lambda p: F.ltrim(p, F.lit("0")))
        fits = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.when(F.length(p) <= 3, p).try_cast("int"), F.lit(0)) <= 255))
        first = F.coalesce(F.get(parts, F.lit(0)).try_cast("int"), F.lit(0))
        candidate, check, no_check = six | fits, ~six | span.rlike("^(?:[^:]+:){7}[^:]+$"), false
        known, unknown = ~six & first.between(1, 223) & (first != 127), ~six
    elif kind == "card":
        good = _luhn(digits)
        plain = ~span.rlike("[^0-9 -]|[ -]{2}") & good
        candidate, check, no_check = good | before.rlike(_words(CUES[kind][0])), good, ~good
        known, unknown = digits.rlike(_ISSUER), ~digits.rlike(_ISSUER)
    else:
        plain, n = span.startswith("+"), F.length(digits)
        candidate, check, no_check = n.between(9, 15), n.between(10, 15), n < 10
        abroad = span.startswith("+") | span.startswith("00")
        known = abroad & F.ltrim(digits, F.lit("0")).rlike(_CALLING)
        unknown = abroad
    for_it, against = (before.rlike(_words(words)) for words in CUES[kind])
    glued = before.rlike(r"[A-Za-z0-9_/=#$&]$") | behind.rlike(r"^[A-Za-z0-9_/=]")
    votes = {
        "shape": _vote(plain, false),
        "check": _vote(check, no_check),
        "gazetteer": _vote(known, unknown),
        "words": _vote(for_it & ~against, against & ~for_it),
        "edge": _vote(~glued, glued),
    }
    return plain, candidate, votes


_SPAN = (
    "array<struct<kind:tinyint,start:bigint,end:bigint,plain:boolean,"
    + ",".join(f"{name}:tinyint" for name in LABELERS)
    + ",longer:tinyint>>"
)


def _spans(text: Column, kind: str) -> Column:
    pattern = "|".join(f"(?:{p})" for p in PATTERNS[kind])
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_CUT}$0{_CUT}"))

    def judged(pieces: Column) -> Column:
        def one(place: Column) -> Column:
            def with_text(t: Column) -> Column:
                plain, candidate, votes = _judged(kind, t["span"], t["before"], t["behind"])
                longer = reduce(Column.__add__, [(place["n"] >= n).cast("tinyint") for n in LONGER])
                return F.struct(
                    candidate.alias("candidate"),
                    F.struct(
                        F.lit(KINDS.index(kind)).cast("tinyint").alias("kind"),
                        place["start"].alias("start"),
                        (place["start"] + place["n"]).alias("end"),
                        plain.alias("plain"),
                        *[votes[name].alias(name) for name in LABELERS],
                        longer.cast("tinyint").alias("longer"),
                    ).alias("of"),
                )

            around = F.struct(
                F.get(pieces, place["i"]).alias("span"),
                F.right(F.get(pieces, place["i"] - 1), F.lit(BEFORE)).alias("before"),
                F.left(F.get(pieces, place["i"] + 1), F.lit(BEHIND)).alias("behind"),
            )
            return _let(around, with_text)

        return F.transform(F.filter(F.transform(_places(pieces), one), lambda x: x["candidate"]), lambda x: x["of"])

    found = _let(F.split(marked, _CUT, -1), judged)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def candidates(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` without the text but with an array column of candidate spans (its name is returned).

    A number that fails its checksum is a candidate only where a word speaks for it. A candidate has its kind's number, ``start`` and ``end`` in characters, whether it is ``plain``,
    one vote per labeler (1 for, 0 against, -1 none) and how many of the lengths ``LONGER`` it reaches.
    By kind, then start; those of a kind do not overlap. NULL and empty texts have none.
    """
    name = spare_name(docs, "spans")
    source = spare_name(docs, "source_text")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.withColumn(source, F.when(text.contains(_CUT), F.translate(text, _CUT, _NO_CUT)).otherwise(text))
    spans = F.concat(*[_spans(F.col(source), kind) for kind in KINDS])
    return rows.withColumn(name, spans.cast(_SPAN)).drop(source, text_col), name


# ---- reliabilities --------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``chance[kind][labeler]``: how often it votes for, given that a span is one or is none;
    ``share[kind]`` of true spans; ``weights`` of the classifier by feature."""

    chance: dict[str, dict[str, tuple[float, float]]]
    share: dict[str, float]
    weights: dict[str, float]
    intercept: float


def reliabilities(counts: dict[tuple[int, ...], int]) -> tuple[dict[str, tuple[float, float]], float, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over how often each combination of votes occurs, of one kind.

    Returns each labeler's chance of voting for, given a true and a false span, the share of true
    spans, and the probability of every combination. Labelers are taken as independent given the
    truth; each starts with the reliability ``RELIABILITY``, which counts for ``ASSUMED`` spans.
    """
    width = len(LABELERS)
    believed = {}
    for votes in counts:
        spoken = [v for v in votes if v >= 0]
        believed[votes] = (sum(spoken) + 0.5) / (len(spoken) + 1)
    total = sum(counts.values())
    share, chance = 0.5, [(RELIABILITY, 1 - RELIABILITY)] * width
    for _ in range(ROUNDS):
        share = (sum(n * believed[v] for v, n in counts.items()) + ASSUMED / 2) / (total + ASSUMED)
        for k in range(width):
            sums = [[ASSUMED * RELIABILITY, ASSUMED], [ASSUMED * (1 - RELIABILITY), ASSUMED]]
            for votes, n in counts.items():
                if votes[k] >= 0:
                    for truth, weight in enumerate((believed[votes], 1 - believed[votes])):
                        sums[truth][0] += n * weight * votes[k]
                        sums[truth][1] += n * weight
            chance[k] = (sums[0][0] / sums[0][1], sums[1][0] / sums[1][1])
        for votes in counts:
            yes, no = share, 1 - share
            for v, (if_true, if_false) in zip(votes, chance):
                if v >= 0:
                    yes *= if_true if v else 1 - if_true
                    no *= if_false if v else 1 - if_false
            believed[votes] = yes / (yes + no)
    return dict(zip(LABELERS, chance)), share, believed


def _features() -> dict[str, Callable[[Callable[[str], Column]], Column]]:
    """Every feature of the classifier by name, as a condition on a candidate's fields."""
    made: dict[str, Callable[[Callable[[str], Column]], Column]] = {}
    for i, kind in enumerate(KINDS):
        made[kind] = lambda of, i=i: of("kind") == i
        for name in LABELERS:
            for vote in (0, 1):
                made[f"{kind}_{name}_{vote}"] = lambda of, i=i, name=name, vote=vote: (of("kind") == i) & (of(name) == vote)
        for n in range(len(LONGER)):
            made[f"{kind}_longer_{n}"] = lambda of, i=i, n=n: (of("kind") == i) & (of("longer") > n)
    return made


def fit(found: DataFrame, spans_col: str) -> Model:
    """Reliabilities and classifier from the candidates of all rows.

    Candidates are counted by kind, votes and length, which gives a table of bounded size (at most
    four kinds, three votes of five labelers and four lengths) whatever the input; the driver reads
    the combinations of votes, and the classifier is trained on the table, each row once as true and
    once as false, weighed by its number and its probability. No candidates: the added ones all score 0.
    """
    fields = ["kind", *LABELERS, "longer"]
    table = staged(
        found.select(F.explode(f"`{spans_col}`").alias("s")).groupBy(*[F.col(f"s.{f}").alias(f) for f in fields]).agg(F.count(F.lit(1)).alias("n")),
        "pii-votes",
    )
    votes = table.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).orderBy("kind", *LABELERS).collect()
    chance, share, rows = {}, {}, []
    for i, kind in enumerate(KINDS):
        counts = {tuple(r[name] for name in LABELERS): r.n for r in votes if r.kind == i}
        chance[kind], share[kind], believed = reliabilities(counts)
        rows += [(i, *v, p) for v, p in believed.items()]
    if not rows:
        return Model(chance, share, {}, -20.0)
    spark = found.sparkSession
    chances = spark.createDataFrame(rows, ", ".join(f"{f} int" for f in ["kind", *LABELERS]) + ", p double")
    features = _features()
    train = table.join(F.broadcast(chances), ["kind", *LABELERS])  # one row per combination of votes
    train = train.select(*[f(F.col).cast("double").alias(f"f_{name}") for name, f in features.items()], "n", "p")
    both = staged(
        train.withColumn("label", F.lit(1.0)).withColumn("weight", F.col("n") * F.col("p"))
        .unionAll(train.withColumn("label", F.lit(0.0)).withColumn("weight", F.col("n") * (1 - F.col("p"))))
        .where("weight > 0").coalesce(1),
        "pii-training",
    )
    vectors = VectorAssembler(inputCols=[f"f_{name}" for name in features], outputCol="features").transform(both)
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False).fit(vectors)
    weights = {name: float(w) for name, w in zip(features, fitted.coefficients)}
    return Model(chance, share, weights, float(fitted.intercept))


def _score(model: Model, span: Column) -> Column:
    margin = F.lit(model.intercept)
    for name, condition in _features().items():
        weight = model.weights.get(name, 0.0)
        if weight:
            margin = margin + F.when(condition(lambda field: span[field]), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-margin))


def decided(found: DataFrame, spans_col: str, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The candidates that are personal data: all plain ones, and of the others those that the
    classifier gives ``threshold`` or more. Each has a ``score``, 1 for the plain ones."""
    scored = F.transform(
        F.col(f"`{spans_col}`"),
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["plain"].alias("plain"),
            F.when(s["plain"], F.lit(1.0)).otherwise(_score(model, s)).alias("score"),
        ),
    )
    return found.withColumn(spans_col, F.filter(scored, lambda s: s["plain"] | (s["score"] >= threshold)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: numbers of plain spans by kind, the digest of their list, the list of all
    spans (``kind:start:end``, by kind, then start, end exclusive) and the number of those added.

    Every whole text is read once; what is kept of it are its candidates. NULL and empty texts have no
    spans; repeated rows have theirs each; other columns do not matter. No rows, no result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found, name = candidates(rows)
    found = staged(found, "pii-candidates")
    done = decided(found, name, fit(found, name))
    plain = F.filter(F.col(name), lambda s: s["plain"])

    def many(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return done.select(
        F.col("id").alias(id_col),
        *map(many, KINDS),
        F.sha2(_listed(plain), 256).alias("base_sha256"),
        _listed(F.col(name)).alias("spans"),
        (F.size(name) - F.size(plain)).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that overlap become one mark."""
    copy = spare_name(docs, "whole_text")
    found, name = candidates(docs.withColumn(copy, F.col(f"`{text_col}`")), text_col)
    done = decided(found, name, model, threshold)
    text = F.coalesce(F.col(copy), F.lit(""))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(F.col(name), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(
        ordered,
        none,
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(names, s["kind"].cast("int"))).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    clean = F.when(F.size(name) == 0, F.col(copy)).otherwise(cut)
    return done.withColumn(text_col, clean).select(*docs.columns)
