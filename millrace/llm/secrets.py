"""Secrets in texts: candidates by form, false alarms removed by a random forest.

A candidate is a known form of key wherever it stands; or the value after a telling name and
a sign of assignment, quoted or not, whatever its length and signs and however long the name
and the blanks are; or a run of at least 16 characters of ``[A-Za-z0-9+/_-]`` with a letter
and a digit, with its padding.  ``=`` parts a name from its value; a telling name that a value
follows is no candidate itself.  Features are the length, the share of character changes between
classes and the classes' shares, distinct characters, how much of it dictionary words cover,
what its path says, and its neighbouring words.  A random forest trained from labelled findings
tells secrets from identifiers, addresses and placeholders.  Findings are labelled by how they
came to be, not by their features: they are planted, random values against made-up ones
(``planted``); a table of reviewed findings may be given instead.

The dictionary holds the words of all texts.  Everything is DataFrame functions and the forest
of Spark's own machine learning package.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import stable

NEAR = 40
WORD_SHARE, WORD_TEXTS = 1e-5, 3
FINDINGS, PLANTS = 20_000, 60
TREES, DEPTH = 20, 8

# Words that go with secrets, and words that go with made-up ones.
_TELLS = "(?i:api.?key|token|secret|passw|pwd|credential|auth(?!ors?(?![a-z]))|bearer|private.?key|access.?key)"
_FAKES = "(example|sample|dummy|placeholder|changeme|your|xxxx+|test|fixture|mock|redacted)"
_FAKE = f"(?i)(?<![a-z]){_FAKES}s?(?![a-z])"
_FORMS = (r"(?:AKIA[0-9A-Z]{16}(?![0-9A-Z])|gh[pousr]_[A-Za-z0-9]{36,}+|xox[baprs]-[A-Za-z0-9-]{10,}+"
          r"|(?<![A-Za-z0-9])sk_live_[A-Za-z0-9]{16,}+|glpat-[A-Za-z0-9_-]{20}(?![A-Za-z0-9_-]))")
_KNOWN = f"^{_FORMS}$"

# Repeats are possessive, lazy or of single characters: the matcher does not recurse, however long a run is.
# A run of name signs is read once, from its start up to its first telling word and on to its end.
_RUN, _NAMED = "[A-Za-z0-9+/_-]", "[A-Za-z0-9_.-]"
_NAME = rf"(?>(?:(?!{_FORMS}){_NAMED})*?(?=[A-Da-dPpSsTt]){_TELLS})(?:(?!{_FORMS}){_NAMED})*+"
_QUOTE = r"""(?:\\?["'`])?+"""
_SIGN = rf"{_QUOTE}\]?+[ \t]*+(?>[:=]?=>?|:|>)"
_GIVEN = rf"{_NAME}(?:{_SIGN}[ \t]*+|(?<=(?i:bearer))[ \t]++)"
_QUOTED = "|".join([rf"{q}(?=\S)(?:(?!{_FORMS})(?:\\.|[^{q}\\\r\n]))++" for q in "\"'`"] + [rf"\\{q}(?=\S)(?:(?!{_FORMS})[^{q}\\\r\n])++" for q in "\"'"])
# A full stop at the end of a value is the sentence's; a value that is a telling name with a sign and a blank is none.
_PLAIN = (rf"(?!(?i:bearer|basic)\s|{_NAME}{_SIGN}[ \t])"
          rf"""(?:(?!{_FORMS})[^\s"'`\\,;&<>()\[\]{{}}|.]|\.++(?=\S))++""")
# A line NAME=value without blanks: all signs up to the blank; elsewhere signs that end a query's or a call's value do so.
_LINE = (rf"""(?<![^\r\n])(?i:export |set )?{_NAME}=(?![=>\s"'`]|\\["'`])"""
         rf"(?:(?!{_FORMS})[^\s,;)}}\]>]|[,;)}}\]>]++(?=\S))++")
_HIT = rf"{_GIVEN}(?:{_QUOTED}|{_PLAIN})"
_CUT = rf"(?!{_FORMS}|(?<!{_NAMED}){_HIT})"
CANDIDATE = (rf"{_FORMS}|{_LINE}|(?:(?<!{_NAMED})|\G){_HIT}"
             rf"|(?:(?<!{_RUN})|\G)(?={_RUN}{{16}})(?=(?:{_CUT}[A-Za-z+/_-])*+{_CUT}[0-9])(?=(?:{_CUT}[0-9+/_-])*+{_CUT}[A-Za-z])"
             rf"(?:{_CUT}{_RUN}){{16,}}+(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?")
# What stands before the value in a match.
_BEFORE = rf"(?s)^(?i:export |set )?{_GIVEN}{_QUOTE}(?=.)"
# A dictionary word stands alone; the words inside a candidate are told apart by their capitals.
_WORD = r"(?<![\p{L}\p{N}_+/-])\p{L}{3,}+(?![\p{L}\p{N}_+/-])"
_PART = r"\p{Lu}?\p{Ll}++|\p{Lu}+(?!\p{Ll})|[\p{L}&&[^\p{Lu}\p{Ll}]]++"

FEATURES = ["length", "changes", "digits", "uppers", "signs", "hexadecimal", "distinct", "covered", "fake_path", "telling", "assigned", "quoted", "fake_near", "known"]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """key, path, start and end (characters), candidate, and up to 40 characters on either side.

    All candidates of the whole text, left to right.  Null and empty texts have none; repeated
    rows have theirs each; other columns are left out.
    """
    found = F.regexp_extract_all(F.col("text"), F.lit(CANDIDATE), F.lit(0))
    between = F.split(F.col("text"), CANDIDATE, -1)
    rows = docs.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    rows = rows.select("key", "path", F.struct(found.alias("found"), between.alias("between")).alias("cut")).filter(F.size("cut.found") > 0)

    def place(acc, i):
        start = acc["at"] + F.length(acc["between"][i])
        return F.struct((start + F.length(acc["found"][i])).alias("at"), F.array_append(acc["starts"], start).alias("starts"),
                        acc["found"].alias("found"), acc["between"].alias("between"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"), F.col("cut.found").alias("found"), F.col("cut.between").alias("between"))
    starts = F.aggregate(F.sequence(F.lit(0), F.size("cut.found") - 1), first, place, lambda acc: acc["starts"])
    # A neighbour may be a candidate itself, such as a long name before its value.  Only the lambda's own
    # variable is used in it: a column named there would be matched anew for every candidate.
    n, none = F.size("cut.found"), F.array(F.lit(""))
    left = lambda name: F.transform(F.col(f"cut.{name}"), lambda x: F.left(x, F.lit(NEAR)))
    right = lambda name: F.transform(F.col(f"cut.{name}"), lambda x: F.right(x, F.lit(NEAR)))
    near = F.slice(F.arrays_zip(
        F.col("cut.found").alias("x"), F.concat(none, right("between")).alias("a"), F.concat(none, right("found")).alias("b"), right("between").alias("c"),
        F.slice(left("between"), F.lit(2), n).alias("d"), F.concat(F.slice(left("found"), F.lit(2), n), none).alias("e"), F.concat(F.slice(left("between"), F.lit(3), n), none).alias("f")), F.lit(1), n)
    one = F.transform(near, lambda z, i: F.struct(
        i.alias("i"), z["x"].alias("candidate"), F.right(F.concat(z["a"], z["b"], z["c"]), F.lit(NEAR)).alias("before"), F.left(F.concat(z["d"], z["e"], z["f"]), F.lit(NEAR)).alias("after")))
    rows = rows.select("key", "path", F.explode(F.arrays_zip(one.alias("one"), starts.alias("start"))).alias("x"))
    rows = rows.select("key", "path", F.col("x.start").cast("long").alias("at"), "x.one.*").withColumn("name", F.regexp_extract("candidate", _BEFORE, 0))
    start, value = F.col("at") + F.length("name"), F.substring("candidate", F.length("name") + 1, F.length("candidate"))
    return rows.select("key", "path", start.alias("start"), (F.col("at") + F.length("candidate")).alias("end"), value.alias("candidate"),
                       F.right(F.concat("before", "name"), F.lit(NEAR)).alias("before"), "after")


def dictionary(docs: DataFrame, text: str = "text", share: float = WORD_SHARE, texts: int = WORD_TEXTS) -> DataFrame:
    """``word``: the lower-cased words of three letters or more that stand in at least ``texts`` texts and a ``share`` of all."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(_WORD), F.lit(0)))).alias("word"))
    return stable(words.groupBy("word").count().filter(F.col("count") >= max(texts, share * docs.count())).select("word"))


def _covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found``, written once, with ``held``: the characters of each candidate that stand in dictionary words; null for none."""
    found = stable(found).withColumn("__id", F.md5("candidate"))
    parts = F.filter(F.regexp_extract_all("candidate", F.lit(_PART), F.lit(0)), lambda p: F.length(p) > 2)
    parts = found.groupBy("__id").agg(F.min("candidate").alias("candidate")).select("__id", F.explode(parts).alias("part"))
    # The candidate itself, however long, is not carried along with its parts.
    parts = parts.groupBy("__id", F.lower("part").alias("word")).agg(F.sum(F.length("part")).alias("n"))
    held = parts.join(words, "word").groupBy("__id").agg(F.sum("n").alias("held"))
    return found.join(held, "__id", "left").drop("__id")


def _share(token: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(token, f"[^{kept}]", "")) / F.length(token)


def with_features(found: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``found`` with FEATURES; without a dictionary nothing is covered."""
    token = F.col("candidate")
    found = _covered(found, words) if words else found.withColumn("held", F.lit(None).cast("long"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.withColumns({
        "length": F.length(token).cast("double"),
        "changes": (F.size(F.regexp_extract_all(token, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0))) - 1) / F.length(token),
        "digits": _share(token, "0-9"), "uppers": _share(token, "A-Z"), "signs": 1 - _share(token, "A-Za-z0-9"), "hexadecimal": _share(token, "0-9a-f"),
        "distinct": F.size(F.array_distinct(F.split(token, ""))).cast("double"),
        "covered": F.coalesce("held", F.lit(0)) / F.length(token),
        "fake_path": flag(F.col("path").rlike(_FAKE)), "telling": flag(F.col("before").rlike(_TELLS)),
        "assigned": flag(F.col("before").rlike("(?:[=:>]\\s*\\\\?[\"'`]?|(?i:bearer)\\s+)$")), "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^\\\\?[\"'`]")),
        "fake_near": flag(F.col("before").rlike(_FAKE) | token.rlike(f"(?i){_FAKES}")), "known": flag(token.rlike(_KNOWN)),
    }).drop("held")


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` (with features) with ``label``: sure secrets 1, sure false alarms 0, others left out.

    For corpora that come without labelled findings.  A secret has a known form, or is
    assigned to a telling name and looks random; a false alarm is a placeholder, is made of
    dictionary words, or has no telling neighbour at all.
    """
    short = lambda n, share: F.least(F.lit(float(n)), F.col("length") * share)
    fake = (F.col("fake_near") > 0) | (F.col("fake_path") > 0) | (F.col("covered") > 0.6) | (F.col("distinct") < short(6, 0.5)) | ~F.col("candidate").rlike("[\\p{L}\\p{N}]")
    random = (F.col("digits") > 0) & F.col("candidate").rlike("^(?=\\S*\\p{L})\\S{6,}$") & (F.col("distinct") >= short(10, 0.75))
    sure = ~fake & ((F.col("known") > 0) | ((F.col("telling") > 0) & (F.col("assigned") > 0) & random))
    alarm = fake | ((F.col("telling") == 0) & (F.col("assigned") == 0) & (F.col("known") == 0))
    return found.withColumn("label", F.when(sure, 1.0).when(alarm, 0.0)).filter("label is not null")


# Names, and texts around a value, of the planted findings.  {n} is a name, {N} that of a variable, {v} a random value, {w} {x} {y} words of the corpus.
_NAMES = ["API_KEY", "api-key", "db_password", "client_secret", "auth_token", "accessToken", "PASSWORD", "token", "aws_secret_access_key", "pwd", "credentials"]
_SECRETS = ['{n}={v}', '{n} = "{v}"', "{n}: '{v}'", '"{n}": "{v}",', "export {n}={v}", "{w} {n}: {v} {x}", "https://{w}.net/{x}?{n}={v}&{y}=1",
            "Authorization: Bearer {v}", "{w} {x} {n} = {v}; {y}", "<{n}>{v}</{n}>"]
_LOOSE = ["{w} {v} {x}", "{w}: {v}", '{w}("{v}")', "{x} {y} {v}."]
_ALARMS = ["{n}: {w}", '{n} = "{w} {x} {y}"', "{n}={w}", "{n}: {w}_{x}", "{n} = get_{w}_{x}", "{n}=your_{w}_here", '{n}: "example-{w}-{d}"', "{n}=changeme{d}", "{n}: xxxxxxxxxxxxxxxx",
           '{n} = "${{w}}"', '{n} = "{{ {w}.{x} }}"', "{n}: <{w}>", "{n} = os.environ", "{n}: none", "{n}: null", "{n}=true", '{n} = "{{ {x}.{N} }}"', "{n}=${N}", '{n}: "${{ {N} }}"', "{n}={N}", "{n} = process.{x}.{N}", '{n} = "example{v}"', "{n}: {v}_placeholder", '{n}="{w}.{x}"',
           "{w}_{x}_{y}_v{d}", "/{w}/{x}{d}/{y}/index.html", "{w}-{x}-{y}-{d}", "https://www.{w}.com/{x}/{y}/{d}", "{w}_{d}_{x}_{y}", "id={w}{x}{d}{y}", "img_{d}{d}_{w}_{x}.png",
           "commit {h}", "see commit {h} {w}", "sha256:{h}{g}", "md5 {g}", "etag: {h}", "{w} {u} {x}", "id={u}", "rev {h} {x}", "{w}={d}{d}{d}{h}", "checksum {h}"]


def planted(spark: SparkSession, words: DataFrame, plants: int = PLANTS, seed: int = 0) -> DataFrame:
    """Findings (with features and ``label``) in made texts, ``plants`` of each kind.

    A random value drawn for a key, password or known form is a secret; names, words of the
    corpus, digests, numbers and values marked as made up are false alarms, and so is all that
    a path calls a test.  The label follows from what was planted, whatever its features.
    """
    some = [r[0] for r in words.orderBy(F.xxhash64("word"), "word").limit(1000).collect()] or ["value"]
    corpus, names = F.split(F.lit(" ".join(some)), " "), F.array(*[F.lit(n) for n in _NAMES])
    drawn = lambda tag: F.sha2(F.concat_ws(":", F.lit(seed), "kind", "id", F.lit(tag)), 256)
    pick = lambda of, tag: F.get(of, F.pmod(F.xxhash64(drawn(tag)), F.size(of)).cast("int"))
    letters = F.regexp_replace(F.concat(*[F.base64(F.unhex(drawn(t))) for t in ("a", "b")]), "[+/=]", "")
    size = 12 + F.pmod(F.xxhash64(drawn("size")), F.lit(29)).cast("int")
    values = {
        "alnum": F.left(letters, F.greatest(size, F.lit(20))), "hex": F.left(drawn("h"), F.when(size % 2 == 0, 32).otherwise(40)), "base64": F.base64(F.unhex(F.left(drawn("b"), size - size % 2))),
        "typed": F.concat(F.lower(F.left(letters, F.lit(4))), pick(F.split(F.lit("! # $ @ % * ! _ -"), " "), "sign"), F.right(letters, F.pmod(size, F.lit(6)) + 4), pick(F.split(F.lit("7 ! 42 x9 $1"), " "), "end")),
        "worded": F.concat(F.initcap(pick(corpus, "pw")), pick(F.split(F.lit("! # $ @ % 1 2"), " "), "sign"), F.left(F.regexp_replace(drawn("n"), "[^0-9]", ""), F.lit(4)), F.left(letters, F.lit(3))),
        "akia": F.concat(F.lit("AKIA"), F.left(F.upper(letters), F.lit(16))), "github": F.concat(F.lit("ghp_"), F.left(letters, F.lit(36))),
        "slack": F.concat(F.lit("xoxb-"), F.left(letters, F.lit(24))), "stripe": F.concat(F.lit("sk_live_"), F.left(letters, F.lit(24))), "gitlab": F.concat(F.lit("glpat-"), F.left(letters, F.lit(20))),
    }
    forms = ["akia", "github", "slack", "stripe", "gitlab"]
    kinds = ([(1.0, v, t) for v in values for t in _SECRETS] + [(1.0, v, t) for v in ["alnum", *forms] for t in _LOOSE] + [(0.0, "alnum", t) for t in _ALARMS])
    kind = F.array(*[F.struct(F.lit(y).alias("label"), F.lit(v).alias("value"), F.lit(t).alias("text")) for y, v, t in kinds])
    rows = spark.range(plants).select("id", F.posexplode(kind).alias("kind", "x")).select("id", "kind", "x.*")
    value = F.coalesce(*[F.when(F.col("value") == k, v) for k, v in values.items()])
    hexes = drawn("x")
    fill = {"{n}": pick(names, "name"), "{N}": F.upper(F.concat(pick(corpus, "w"), F.lit("_"), F.replace(pick(names, "other"), F.lit("-"), F.lit("_")))), "{w}": pick(corpus, "w"), "{x}": pick(corpus, "x"), "{y}": pick(corpus, "y"), "{v}": F.col("value"), "{d}": F.left(F.regexp_replace(drawn("d"), "[^0-9]", ""), F.lit(4)),
            "{h}": F.left(hexes, F.lit(40)), "{g}": F.right(hexes, F.lit(24)), "{u}": F.regexp_replace(F.left(drawn("u"), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")}
    # One value in six is marked as made up.
    marks = F.split(F.lit("example sample- dummy_ placeholder changeme your- test_ mock-"), " ")
    mark = F.when(F.pmod(F.xxhash64(drawn("made up")), F.lit(6)) == 0, pick(marks, "mark"))
    rows = rows.withColumns({"value": F.concat(F.coalesce(mark, F.lit("")), value), "label": F.when(mark.isNull(), F.col("label")).otherwise(0.0)})
    text = F.col("text")
    for mark, what in fill.items():
        text = F.replace(text, F.lit(mark), what)
    tested = F.pmod(F.xxhash64(drawn("path")), F.lit(10)) == 0
    rows = rows.select(F.struct("label", "value", tested.alias("tested")).alias("key"), F.when(tested, "tests/fixtures").otherwise("src/main").alias("path"), text.alias("text"))
    found = with_features(candidates(stable(rows.repartition(8)), "key", "text", "path"), words)
    meant = F.contains("key.value", "candidate") | F.contains("candidate", "key.value")
    return found.filter(meant | (F.col("key.label") == 0)).withColumn("label", F.when(F.col("key.tested"), 0.0).otherwise(F.col("key.label")))


class Forest:
    """A fitted forest, or a constant where the findings had one class only."""

    def __init__(self, model, constant: float):
        self.model, self.constant = model, constant

    def scored(self, found: DataFrame) -> DataFrame:
        if self.model is None:
            return found.withColumn("score", F.lit(self.constant))
        ready = VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(found)
        return self.model.transform(ready).withColumn("score", vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame, findings: int = FINDINGS, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """A forest from findings with features and ``label``; classes weigh alike.

    Equal findings are counted first and weigh as often as they stand.  Of more than ``findings``
    different ones of a label a share by hash is taken, about as many.  No findings: the score
    0.5; one class: its label.
    """
    rows = stable(labelled.groupBy(*FEATURES, "label").agg(F.count("*").alias("n"))).withColumn("__key", F.xxhash64(*FEATURES, "label"))
    share = {r[0]: findings / r[1] for r in rows.groupBy("label").count().collect()}
    if len(share) < 2:
        return Forest(None, float(next(iter(share), 0.5)))
    low = F.pmod("__key", F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.filter(low < F.when(F.col("label") == 1, share[1.0]).otherwise(share[0.0]))
    size = {r[0]: r[1] for r in rows.groupBy("label").agg(F.sum("n")).collect()}
    weighted = rows.withColumn("weight", F.col("n") * F.when(F.col("label") == 1, 1 / size[1.0]).otherwise(1 / size[0.0]) * F.lit(sum(size.values()) / 2))
    # The order of rows decides ties in the trees' bootstraps.
    weighted = weighted.repartitionByRange(8, "__key").sortWithinPartitions("__key")
    ready = VectorAssembler(inputCols=FEATURES, outputCol="__x").transform(weighted)
    forest = RandomForestClassifier(featuresCol="__x", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11, minInstancesPerNode=2)
    return Forest(forest.fit(ready), 0.5)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: key, path, start, end, candidate, score, secret (score from ``threshold`` on).

    ``labelled`` are findings with features and labels; by default those of ``planted``.
    """
    words = dictionary(docs, text)
    found = stable(with_features(candidates(docs, key, text, path), words))
    forest = fit(planted(docs.sparkSession, words) if labelled is None else labelled)
    scored = forest.scored(found)
    return scored.select(F.col("key").alias(key), F.col("path"), "start", "end", "candidate", "score", (F.col("score") >= threshold).alias("secret"))
