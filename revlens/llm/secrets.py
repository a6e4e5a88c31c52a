"""Secret scans: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import spare_name, staged

#: Words of the corpus dictionary: the most frequent ones.
DICTIONARY = 2000
#: Rows of each kind of labelled finding a fit takes.
FIT_ROWS = 300
TREES, DEPTH, SEED = 24, 7, 7
THRESHOLD = 0.5
MARK = "[SECRET]"

# What a candidate is. Each pattern has two groups, what leads to the value and the
# value; they are looked for one by one, so that none hides what another finds.
_RUN = "[A-Za-z0-9_+/-]"
_WORDY = "token|secret|pass(?:w(?:or)?d|phrase|code)?|pwd|api[_-]?key|credentials?|private|access|auth|bearer|key"
_ENDS = "[,;.)\\]}>\"'`]{0,8}(?:\\s|$)|[&;,][\"'`]?[\\w-]+[\"'`]?[=:]"
_PATTERNS = (
    # a value behind a secret word and a sign, quoted up to its quote
    f"((?i:(?:{_WORDY})[\\w-]*[\"'`\\])]{{0,2}}[ \\t]*[:=]{{1,3}}>?\\s*(?:(?:bearer|basic|token)[ \\t]+)?|bearer[ \\t]+)[\"'`]?)"
    "((?<=\")[^\\s\"]{6,}|(?<=')[^\\s']{6,}|(?<=`)[^\\s`]{6,}|(?<![\"'`])[^\\s\"'`]\\S{5,}?(?=" + _ENDS + "))",
    # the password of an address
    "(://[^\\s/:@\"'<>]*+:)([^\\s/\"'<>]+)(?=@)",
    # a private key, or its header where the end is missing
    "()(-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)?)",
    # a run with a digit, of 16 or, behind "=", of 8; letters whose case changes often; "=" ends it as padding only
    f"()(?<!{_RUN})((?:(?=[A-Za-z_+/-]*[0-9])(?:{_RUN}{{16,}}|(?<==){_RUN}{{8,}})|(?=(?:[A-Za-z_+/-]*?[a-z][A-Z]){{3}}){_RUN}{{16,}})"
    "(?:={1,3}(?![A-Za-z0-9_+/=-]))?)",
    # parts joined by dots
    "()(?<![\\w.+/-])((?=[\\w.-]{20})(?=[\\w.-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9_-]{2,}(?:\\.[A-Za-z0-9_-]{4,}){1,8})(?![\\w.-]*[/@(])",
)
#: From this length on a secret's equals elsewhere in its text go too.
LONG = 16
#: Characters on each side of a candidate that its neighbouring words are taken from.
AROUND = 1024
#: Stands between the pieces of a text; one in the text itself counts as the other.
_CUT, _NO_CUT = "\uffff", "\ufffe"

# Words beside secrets, words beside other long strings, words of example paths.
_SECRET_WORDS = "token|secret|passw|pwd|api_?-?key|apikey|access|auth|credential|private|bearer|key"
_OTHER_WORDS = "commit|sha[0-9]*|md5|hash|checksum|uuid|guid|revision|etag|digest|integrity|card|phone|order|isbn|version"
_EXAMPLE_WORDS = "example|sample|placeholder|changeme|your|dummy|test|xxxx|mock|fixture"

FEATURES = (
    "length upper lower digits symbols class_changes case_changes repeats distinct hex dictionary slashes dashes "
    "prefixed secret_word other_word example_word assigned quoted is_mail is_url example_path path_depth "
    "others dots in_url key_block"
).split()


def _share(run: Column, pattern: str) -> Column:
    return F.regexp_count(run, F.lit(pattern)) / F.length(run)


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """The features of findings: ``run`` with ``before`` and ``behind`` it in its word, three words
    ``prev``, the word ``next`` and the ``path``."""
    run, before, behind = F.col("run"), F.col("before"), F.col("behind")
    near = F.lower(F.concat_ws(" ", F.col("prev"), before))
    words = F.regexp_extract_all(F.lower(run), F.lit("[a-z]+"), 0)
    known = F.split(F.lit(" ".join(dictionary)), " ")  # one literal, however many words
    covered = F.aggregate(
        F.filter(words, lambda w: F.array_contains(known, w)), F.lit(0), lambda n, w: n + F.length(w)
    ) / F.length(run)
    path = F.coalesce("path", F.lit(""))
    values = {
        "length": F.least(F.length(run), F.lit(256)),
        "upper": _share(run, "[A-Z]"),
        "lower": _share(run, "[a-z]"),
        "digits": _share(run, "[0-9]"),
        "symbols": _share(run, "[_+/=-]"),
        "class_changes": _share(run, "(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]"),
        "case_changes": _share(run, "(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        "repeats": _share(run, r"(.)(?=\1)"),
        "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.least(F.length(run), F.lit(64)),
        "hex": F.lower(run).rlike("^[0-9a-f]+$"),
        "dictionary": covered,
        "slashes": _share(run, "/"),
        "dashes": _share(run, "-"),
        "prefixed": run.rlike("^(AKIA|ASIA|gh[pousr]_|sk-|sk_|pk_|xox[abprs]-|eyJ|AIza|glpat-)"),
        "secret_word": near.rlike(_SECRET_WORDS),
        "other_word": near.rlike(rf"(^|[^a-z])({_OTHER_WORDS})([^a-z]|$)"),
        "example_word": F.lower(F.concat_ws(" ", near, run, F.col("next"))).rlike(_EXAMPLE_WORDS),
        "assigned": F.concat_ws(" ", F.col("prev"), before).rlike(r"[:=]\W*$"),
        "quoted": before.rlike("[\"'`]$"),
        "is_mail": behind.startswith("@") | behind.rlike(r"^\.[\w.]*@"),
        "is_url": before.contains("://") | before.rlike(r"[./]$"),
        "example_path": F.lower(path).rlike(_EXAMPLE_WORDS),
        "path_depth": F.least(F.regexp_count(path, F.lit("/")), F.lit(20)),
        "others": _share(run, "[^A-Za-z0-9_+/=.-]"),
        "dots": _share(run, "[.]"),
        "in_url": before.rlike("://[^/:@]*:$") & behind.startswith("@"),
        "key_block": run.startswith("-----BEGIN "),
    }
    return found.select("*", *[F.coalesce(values[n].cast("double"), F.lit(0.0)).alias(f"f_{n}") for n in FEATURES])


def dictionary_of(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The ``DICTIONARY`` most frequent lower-case words of all texts; counted within tasks first.

    They are written before they are read, so the driver merges no task's own list.
    """
    rows = (
        docs.select(F.explode(F.split(text_col, "\\s+")).alias("w"))
        .where(F.length("w").between(3, 12) & F.col("w").rlike("^[a-z]+$"))
        .groupBy("w")
        .count()
        .orderBy(F.desc("count"), "w")
        .limit(DICTIONARY)
    )
    return [r["w"] for r in staged(rows, "dictionary").orderBy(F.desc("count"), "w").collect()]


def labelled_findings(spark: SparkSession, dictionary: list[str]) -> DataFrame:
    """Findings with labels (1: secret) made by known rules: what secrets look like in use, and what
    else looks like them. Random parts are digests of the row number, words are the corpus' own.

    The rules make texts, and ``candidates`` finds what is labelled in them, so a fit sees the shapes
    a scan sees.
    """
    words = F.split(F.lit(" ".join(dictionary or ["the", "and", "value", "line"])), " ")
    drawn = (*range(1, 10), 40)

    def word(n: int) -> Column:  # drawn once per row, below
        return F.col(f"word{n}")

    def draw(n: int) -> Column:
        return F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(n)), F.size(words)) + 1).cast("int"))

    def digest(n: int) -> Column:
        return F.sha2(F.concat_ws(":", F.col("id"), F.lit(n)), 512)

    def mixed(n: int, size: int, symbols: bool = False) -> Column:
        text = F.base64(F.unhex(digest(n)))
        return F.substring(text if symbols else F.regexp_replace(text, "[+/=\\s]", "x"), 1, size)

    def number(n: int, size: int) -> Column:
        return F.substring(F.regexp_replace(digest(n), "[a-f]", "7"), 1, size)

    quote = F.when(F.col("id") % 3 == 0, F.lit('"')).when(F.col("id") % 3 == 1, F.lit("'")).otherwise(F.lit(""))
    name = F.element_at(
        F.array(*[F.lit(x) for x in ("token", "api_key", "secret", "password", "auth_token", "TOKEN", "SECRET_KEY", "access_key")]),
        (F.pmod(F.xxhash64("id", F.lit("name")), F.lit(8)) + 1).cast("int"),
    )
    equals = F.when(F.col("id") % 2 == 0, F.lit("=")).otherwise(F.lit(":"))
    junk = F.element_at(F.array(F.lit(""), F.lit("***"), F.lit("%%%"), F.lit("!!")), (F.col("id") % 4 + 1).cast("int"))
    neutral = [word(1), word(2), word(3)]
    none = F.lit("")
    other = F.element_at(
        F.array(*[F.lit(x) for x in ("commit", "md5", "checksum", "sha1", "revision", "digest", "etag", "hash")]),
        (F.pmod(F.xxhash64("id", F.lit("other")), F.lit(8)) + 1).cast("int"),
    )
    assign = F.concat(name, F.lit("="), quote)
    about = F.element_at(
        F.array(*[F.lit(x) for x in ("author", "key", "keywords", "access", "authority", "passage", "keyboard", "private")]),
        (F.pmod(F.xxhash64("id", F.lit("about")), F.lit(8)) + 1).cast("int"),
    )
    scheme = F.element_at(
        F.array(*[F.lit(x) for x in ("https", "postgres", "mysql", "redis", "amqp", "mongodb+srv")]),
        (F.pmod(F.xxhash64("id", F.lit("scheme")), F.lit(6)) + 1).cast("int"),
    )
    key_kind = F.element_at(
        F.array(*[F.lit(x) for x in ("RSA ", "", "EC ", "OPENSSH ")]), (F.col("id") % 4 + 1).cast("int")
    )
    block = F.concat(
        F.lit("-----BEGIN "), key_kind, F.lit("PRIVATE KEY-----\n"), mixed(49, 64, True), F.lit("\n"), mixed(50, 30, True),
        F.lit("=\n-----END "), key_kind, F.lit("PRIVATE KEY-----"),
    )

    def letters(n: int, size: int) -> Column:
        return F.substring(F.concat(F.translate(mixed(n, 64), "0123456789", "kQvZdXmRwB"), F.lit("aQzKxWmT")), 1, size)

    def odd(n: int, size: int, rest: int) -> Column:
        sign = F.substring(F.lit("!$%#*?^!"), (F.pmod(F.xxhash64("id", F.lit(n)), F.lit(8)) + 1).cast("int"), F.lit(1))
        return F.concat(mixed(n, size), sign, mixed(n + 1000, rest))

    kinds: list[tuple[int, list[Column], Column, Column, Column]] = [
        # label, three words before, in the word before, the run, in the word behind
        (1, [word(1), name, equals], quote, F.substring(digest(1), 1, 40), quote),
        (1, [word(1), F.concat(name, junk), F.concat(equals, junk)], quote, F.substring(digest(2), 1, 40), F.concat(quote, junk)),
        (1, [word(1), name, equals], quote, F.upper(F.substring(digest(3), 1, 40)), quote),
        (1, [word(1), name, equals], quote, F.substring(digest(4), 1, 32), quote),
        (1, [word(1), name, equals], quote, mixed(5, 40), quote),
        (1, [word(1), word(2), F.concat(name, F.lit(":"))], quote, F.substring(mixed(6, 60, True), 1, 24), quote),
        (1, [word(1), word(2), F.lit("export")], F.concat(name, F.lit("=")), mixed(7, 32), none),
        (1, neutral, none, F.concat(F.lit("AKIA"), F.upper(F.substring(mixed(8, 16), 1, 16))), none),
        (1, neutral, quote, F.concat(F.lit("ghp_"), mixed(9, 36)), quote),
        (1, neutral, quote, F.concat(F.lit("sk-"), mixed(10, 48)), quote),
        (1, [word(1), F.lit("Authorization:"), F.lit("Bearer")], none, F.concat(F.lit("eyJ"), mixed(11, 60)), F.lit(".")),
        (1, [word(1), name, equals], quote, F.substring(digest(12), 1, 64), quote),
        (0, [word(1), word(2), other], none, F.substring(digest(13), 1, 40), none),
        (0, [word(1), other, equals], quote, F.substring(digest(14), 1, 40), quote),
        (0, neutral, none, F.substring(digest(15), 1, 40), none),
        (0, neutral, F.lit("sha256:"), F.substring(digest(16), 1, 64), none),
        (0, neutral, none, number(17, 16), junk),
        (0, neutral, none, number(18, 19), none),
        (0, neutral, none, F.concat(word(4), word(5), word(6), number(19, 2), word(7), word(8)), none),
        (0, neutral, F.lit("https://"), F.concat(word(4), F.lit("/"), word(5), F.lit("-"), word(6), F.lit("/"), number(20, 6)), none),
        (0, [word(1), F.lit("id"), equals], quote, F.concat_ws("-", F.substring(digest(21), 1, 8), F.substring(digest(21), 9, 4), F.substring(digest(21), 13, 4), F.substring(digest(21), 17, 4), F.substring(digest(21), 21, 12)), quote),
        (0, [word(1), name, equals], quote, F.concat(F.lit("your_"), F.lower(name), F.lit("_here_"), number(22, 3)), quote),
        (0, [word(1), name, equals], quote, F.concat(F.repeat(F.lit("x"), 18), number(23, 1)), quote),
        (0, [word(1), F.lit("key"), equals], none, F.concat_ws("_", word(4), word(5), word(6), number(24, 2)), none),
        (0, neutral, none, F.concat(word(4), word(5), word(6), word(9), number(25, 2)), F.lit("@mail.example.com")),
        (0, neutral, none, F.concat(F.lit("20"), number(26, 6), F.lit("T"), number(27, 6), F.lit("Z")), none),
        (0, neutral, none, F.concat(F.lit("order-"), number(28, 4), F.lit("-"), number(29, 8)), none),
        (0, [word(1), word(2), name], none, F.concat_ws("/", word(4), word(5), word(6), F.concat(word(7), number(30, 1)), word(8)), none),
        # the name in the secret's own word
        (1, neutral, assign, F.substring(digest(31), 1, 40), quote),
        (1, neutral, assign, F.concat(F.lit("ghp_"), mixed(32, 36)), quote),
        (1, [word(1), word(2), F.lit("export")], assign, mixed(33, 24), quote),
        (0, neutral, F.concat(other, F.lit("=")), F.substring(digest(34), 1, 40), none),
        (0, neutral, F.concat(F.lit("https://"), word(4), F.lit(".com/?id=")), number(35, 12), none),
        # short, with other characters, letters only
        (1, [word(1), word(2), F.concat(name, F.lit(":"))], quote, odd(36, 8, 4), quote),
        (1, [word(1), name, equals], quote, odd(37, 6, 5), quote),
        (1, neutral, assign, odd(38, 5, 3), quote),
        (1, [word(1), name, equals], quote, mixed(39, 9), quote),
        (1, [word(1), name, equals], quote, F.concat(word(4), number(41, 2), word(5)), quote),
        (1, neutral, assign, F.concat(word(4), number(42, 4)), quote),
        (1, [word(1), name, equals], quote, letters(43, 24), quote),
        (1, neutral, assign, F.lower(letters(44, 20)), quote),
        (1, neutral, none, letters(45, 32), none),
        (0, [word(1), word(2), F.concat(about, F.lit(":"))], none, word(4), none),
        (0, [word(1), about, equals], quote, F.concat_ws("-", word(4), word(5)), quote),
        (0, [word(1), word(2), F.concat(name, F.lit(":"))], none, F.concat(word(4), word(5)), none),
        (0, [word(1), name, equals], none, F.concat(word(4), F.lit("."), word(5), F.lit("("), word(6), F.lit(")")), none),
        (0, [word(1), name, equals], none, F.concat(F.lit("${"), F.upper(word(4)), F.lit("_"), F.upper(word(5)), F.lit("}")), none),
        (0, [word(1), name, equals], quote, F.concat(F.lit("<your-"), word(4), F.lit(">")), quote),
        (0, neutral, none, F.concat(word(4), F.initcap(word(5)), F.initcap(word(6)), F.initcap(word(7)), F.initcap(word(8))), none),
        # addresses
        (1, neutral, F.concat(scheme, F.lit("://"), word(4), F.lit(":")), odd(46, 5, 3), F.concat(F.lit("@"), word(5), F.lit("/db"))),
        (1, neutral, F.concat(scheme, F.lit("://u:")), F.concat(word(4), number(47, 3)), F.concat(F.lit("@"), word(5), F.lit("/db"))),
        (1, neutral, F.concat(scheme, F.lit("://"), word(4), F.lit(":")), mixed(48, 12), F.concat(F.lit("@"), word(5))),
        (0, neutral, F.concat(scheme, F.lit("://"), word(4), F.lit(":")), F.lit("password"), F.lit("@example.com")),
        # key blocks
        (1, neutral, none, block, none),
        (1, neutral, none, F.concat(F.lit("-----BEGIN "), key_kind, F.lit("PRIVATE KEY-----")), none),
        # parts joined by dots
        (1, [word(1), F.lit("Authorization:"), F.lit("Bearer")], none, F.concat_ws(".", F.concat(F.lit("eyJ"), mixed(51, 17)), mixed(52, 30), mixed(53, 22)), none),
        (1, [word(1), word(2), name], none, F.concat_ws(".", mixed(54, 24), mixed(55, 6), mixed(56, 27)), none),
        (0, neutral, none, F.concat_ws(".", word(4), F.concat(word(5), number(57, 2)), F.concat(word(6), word(7)), F.lit("info")), none),
        (0, neutral, none, F.concat_ws(".", F.concat(word(4), F.initcap(word(5))), F.concat(word(6), F.initcap(word(7))), F.lit("java")), none),
        (0, neutral, none, F.concat(word(4), F.lit("-"), number(58, 8), F.lit("."), word(5), word(6)), none),
    ]
    # one frame of (kind, row): sixty frames of one kind each cost the driver hundreds of MB to plan
    rows = spark.range(0, FIT_ROWS * len(kinds), 1, 4)
    rows = rows.select(F.floor(F.col("id") / FIT_ROWS).alias("kind"), (F.col("id") % FIT_ROWS).alias("id"))
    rows = rows.select("*", *[draw(n).alias(f"word{n}") for n in drawn])

    def of_kind(values: list[Column]) -> Column:
        chosen = F.when(F.col("kind") == 0, values[0])
        for kind, value in enumerate(values[1:], 1):
            chosen = chosen.when(F.col("kind") == kind, value)
        return chosen

    label = F.get(F.array(*[F.lit(k[0]) for k in kinds]), F.col("kind").cast("int"))
    made = rows.select(
        label.alias("label"),
        of_kind([run for *_, run, _ in kinds]).alias("planted"),
        F.concat(of_kind([F.concat_ws(" ", *prev) for _, prev, *_ in kinds]), F.lit(" "), of_kind([k[2] for k in kinds])).alias("lead"),
        F.concat(of_kind([k[4] for k in kinds]), F.lit(" "), word(40)).alias("rest"),
        F.when((label == 0) & (F.col("id") % 10 == 0), F.lit("tests/fixtures/example")).otherwise(F.lit("src")).alias("path"),
    )
    texts = staged(made.select("*", F.concat("lead", "planted", "rest").alias("text")), "labelled-texts")
    meets = (F.col("start") < F.length("k_lead") + F.length("k_planted")) & (F.col("start") + F.length("run") > F.length("k_lead"))
    return candidates(texts, ["label", "planted", "lead"], "text", "path").where(meets).select(
        F.col("k_label").alias("label"), "prev", "before", "run", "behind", "next", "path"
    )


def train(findings: DataFrame, dictionary: list[str]) -> RandomForestClassificationModel:
    """The forest over labelled findings (columns as in ``with_features``, and ``label``)."""
    rows = with_features(staged(findings, "labelled-findings"), dictionary)
    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return forest.fit(vectors.select("features", F.col("label").cast("double")))


def fit(docs: DataFrame, text_col: str = "text", findings: DataFrame | None = None) -> tuple[RandomForestClassificationModel, list[str]]:
    """Forest and dictionary; trained on ``findings`` where given, else on those made by rule."""
    dictionary = dictionary_of(docs, text_col)
    return train(findings if findings is not None else labelled_findings(docs.sparkSession, dictionary), dictionary), dictionary


def _may_hold(text: Column) -> Column:
    return F.coalesce(reduce(Column.__or__, [text.rlike(p) for p in _PATTERNS]), F.lit(False))


def candidates(docs: DataFrame, keep: list[str], text_col: str, path_col: str | None) -> DataFrame:
    """One row per candidate: the columns ``keep``, ``start`` (in characters, from 0) and the run
    with what stands around it, at most ``AROUND`` characters a side."""
    names = [spare_name(docs, f"pieces{i}") for i in range(len(_PATTERNS))]
    text, hit_name = F.col(f"`{text_col}`").cast("string"), spare_name(docs, "hit")
    hit = F.col(hit_name)
    rows = docs.where(_may_hold(text))
    for name, pattern in zip(names, _PATTERNS):
        marked = F.regexp_replace(F.translate(text, _CUT, _NO_CUT), F.lit(pattern), F.lit(f"$1{_CUT}$2{_CUT}"))
        rows = rows.withColumn(name, F.transform(F.split(marked, _CUT, -1), lambda p: F.length(p)))

    def spans(sizes: Column) -> Column:  # every second piece is a run
        placed = F.transform(sizes, lambda n, i: F.struct(i.alias("i"), n.alias("n")))
        return F.transform(
            F.filter(placed, lambda x: (x["i"] % 2 == 1) & (x["n"] > 0)),
            lambda x: F.struct(F.aggregate(F.slice(sizes, 1, x["i"]), F.lit(0), lambda a, n: a + n).alias("start"), x["n"].alias("n")),
        )

    found = rows.withColumn(hit_name, F.explode(F.array_distinct(F.concat(*[spans(F.col(n)) for n in names]))))
    start, end = hit["start"], hit["start"] + hit["n"]
    before = F.substring(text, F.greatest(start - AROUND, F.lit(0)) + 1, F.least(start, F.lit(AROUND)))
    found = found.select(
        *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep],
        start.cast("long").alias("start"),
        F.substring(text, start + 1, hit["n"]).alias("run"),
        F.split(before, "\\s", -1).alias("front"),
        F.split(F.substring(text, end + 1, F.lit(AROUND)), "\\s", -1).alias("back"),
        (F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")).alias("path"),
    )
    n = F.size("front")
    return found.select(
        *[f"k_{c}" for c in keep],
        "start",
        "run",
        F.element_at("front", -1).alias("before"),
        F.element_at("back", 1).alias("behind"),
        F.filter(F.slice("front", F.greatest(n - 3, F.lit(1)), F.least(n - 1, F.lit(3))), lambda w: w != "").alias("prev"),
        F.coalesce(F.get("back", F.lit(1)), F.lit("")).alias("next"),
        "path",
    )


def scan(
    docs: DataFrame,
    model: RandomForestClassificationModel,
    dictionary: list[str],
    keep: list[str],
    text_col: str = "text",
    path_col: str | None = None,
) -> DataFrame:
    """Every candidate of every text, scored: ``k_<column>`` for ``keep``, ``start``, ``run``,
    ``score``, ``is_secret``.

    A candidate is a value of 6 or more characters behind a secret word and ``=`` or ``:``, the
    password of an address, a private key or its header, a run of 16 or more letters, digits and
    ``_+/-`` (8 behind ``=``) with a digit or three changes to upper case, or such parts joined by
    dots. Candidates may overlap; every place of a run is one. NULL and empty texts have none;
    repeated rows have theirs each. No rows, no findings.
    """
    rows = with_features(candidates(docs, keep, text_col, path_col), dictionary)
    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features", handleInvalid="keep").transform(rows)
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*[f"k_{c}" for c in keep], "start", "run", "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def redact(
    docs: DataFrame,
    model: RandomForestClassificationModel,
    dictionary: list[str],
    text_col: str = "text",
    path_col: str | None = None,
) -> DataFrame:
    """The same rows and columns, every secret in the text replaced by ``MARK``.

    Secrets go where they were found, those of ``LONG`` characters or more wherever they stand. Only rows with a candidate are written aside, numbered and joined with their findings; all
    others pass through. Names of other columns do not matter.
    """
    may = _may_hold(F.col(text_col))
    number = spare_name(docs, "row")
    some = staged(docs.where(may).withColumn(number, F.monotonically_increasing_id()), "candidates")
    secrets = (
        scan(some, model, dictionary, [number], text_col, path_col)
        .where("is_secret")
        .groupBy(f"k_{number}")
        .agg(F.sort_array(F.collect_set(F.struct("start", F.length("run").cast("long").alias("n"), "run"))).alias("found"))
        .select(F.col(f"k_{number}").alias("k"), "found")
    )
    text, found = F.col(f"d.`{text_col}`"), F.coalesce("s.found", F.array().cast("array<struct<start:bigint,n:bigint,run:string>>"))
    here, length = F.lit(0).cast("long"), F.length(text).cast("long")

    def cut(done: Column, x: Column) -> Column:  # spans that overlap are one
        end = F.greatest(done["at"], x["start"] + x["n"])
        gap = F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), (x["start"] - done["at"]).cast("int")), F.lit(MARK))
        return F.struct(end.alias("at"), F.when((x["start"] < done["at"]), done["out"]).otherwise(gap).alias("out"))

    first = F.struct(here.alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        found, first, cut, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), length.cast("int")))
    )
    longest = F.reverse(F.array_sort(F.transform(F.filter(found, lambda s: s["n"] >= LONG), lambda s: F.struct(s["n"].alias("n"), s["run"].alias("run")))))
    clean = F.aggregate(longest, clean, lambda t, s: F.replace(t, s["run"], F.lit(MARK)))
    done = some.alias("d").join(secrets.alias("s"), F.col(f"d.`{number}`") == F.col("s.k"), "left")
    done = done.select(*[clean.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns])
    return docs.where(~may).unionAll(done)
