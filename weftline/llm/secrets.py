"""Secret scans with a random forest, in DataFrame expressions alone.

Candidates of the whole text are: what is assigned to a word for secrets, from SHORTEST characters of any kind on; passwords
in addresses; private key blocks; strings with a provider's prefix; and all other runs of at least LONG key characters
that hold a digit or a capital after a small letter. Each is described by its length, character classes and transitions,
the share of it that dictionary words cover, path signs and neighbouring words; a random forest trained on labelled findings
tells secrets from harmless strings. The forest is turned into SQL expressions, so candidates are scored inside their row:
nothing is exploded, shuffled or sent to Python.

Labelled findings: labelled_findings() makes TRAINING of them by rule (keys in assignments and with providers' prefixes,
passwords and passphrases, logins in addresses, key blocks; card numbers, checksums, identifiers, paths, placeholders, data
URIs, settings). Any DataFrame of (left, value, right, label) can be given in their place. The forest of the findings made
by rule is fitted once per process.

Defined cases: null and empty text have no candidates, and null text stays null; repeated rows and null ids are rows of
their own; of overlapping candidates the first stands; an empty table gives no rows; docs may have columns of any names,
and redact() gives them back in their order. Work per row is linear in its text.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import beside, table

SHORTEST, LONG, CONTEXT, TRAINING, TREES, DEPTH, SEED = 6, 16, 48, 4800, 24, 8, 7
#: Share of trees that must vote for a secret.
VOTES = 0.5
REPLACEMENT = "[SECRET]"

_KEY = "A-Za-z0-9+/_=-"
_PREFIXES = "AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|xox[abpr]-|sk_live_|sk_test_|sk-proj-|rk_live_|npm_|eyJ"
#: A word for secrets with its sign of assignment, and a login in an address before its password.
_ASSIGNED = r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[_ -]?key|access[_-]?key|private[_-]?key|credentials?|auth|bearer)[A-Za-z_]{0,12}[\"']?\s{0,2}(?::=|=>|=|:)\s{0,2}[\"'`]?"
_LOGIN = r"://[^\s/:@\"'<>]{1,64}:"
_BLOCK = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,32}PRIVATE KEY-----)?"
_RUNS = "|".join((
    rf"(?<![{_KEY}])(?:{_PREFIXES})[{_KEY}]{{12,}}+",
    rf"(?<![{_KEY}])(?=[{_KEY}]{{{LONG}}})(?=[A-Za-z+/_=-]*+[0-9]|[A-Z0-9+/_=-]*+[a-z0-9+/_=-]++[A-Z])[{_KEY}]++",
))
CANDIDATE = "|".join((rf"{_ASSIGNED}[^\s\"'`<>,;]{{{SHORTEST},}}+", rf"{_LOGIN}[^\s/@\"'<>]{{3,}}+(?=@)", _BLOCK, _RUNS))
#: What a text holds, in small letters, if it has candidates of other kinds than runs.
_SIGNS = ("token", "secret", "passw", "passphrase", "pwd", "api", "access", "private", "credential", "auth", "bearer", "://")
_BEFORE = rf"^(?:{_ASSIGNED}|{_LOGIN})"
#: Words that harmless values are made of.
DICTIONARY = "example sample dummy placeholder changeme your test demo user name value index image file page item post data config build version release python java node lib local share static assets html http https www com org net token key secret password none null true false model train the and for with from this that have not are was required optional string undefined environ process settings bytes basic oauth login session header param type length expired invalid missing enabled disabled get set from env var self here admin root host service client server field input output default current request response handler manager factory builder".split()
_SECRET_WORDS = r"(?i)(?:token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth|bearer|signing)[^A-Za-z]{0,3}\W*$"
_SECRET_NEAR = r"(?i)(?:token|secret|passw|pwd|key|credential|auth|bearer)"
_HARMLESS_NEAR = r"(?i)(?:sha-?\d|md5|checksum|digest|hash|commit|revision|uuid|guid|etag|card|iban|phone|isbn|order|invoice|serial|base64)"

FEATURES = ("length", "digits", "upper", "lower", "hex", "other", "distinct", "transitions", "letter_runs", "covered", "slashes", "in_path", "assigned", "quoted", "secret_word", "secret_near", "harmless_near", "prefix", "special", "block", "login")


def features(left: Column, value: Column, right: Column) -> dict[str, Column]:
    """The forest's inputs for a value between its neighbouring text."""
    n = F.length(value).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    words = "(?i)" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    flag = lambda c: c.cast("double")
    return {
        "length": n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "hex": share("[0-9a-f]"),
        "other": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "transitions": share("(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "letter_runs": share("[A-Za-z]{4,}"),
        "covered": (n - F.length(F.regexp_replace(value, words, ""))) / n,
        "slashes": share("/"),
        "in_path": flag(left.rlike(r"(?:[./\\~]|://\S*)$") | right.rlike(r"^\.[A-Za-z]{1,5}\b")),
        "assigned": flag(left.rlike(r"[=:]\s*[\"'`]?$")),
        "quoted": flag(left.rlike("[\"'`]$") & right.rlike("^[\"'`]")),
        "secret_word": flag(left.rlike(_SECRET_WORDS)),
        "secret_near": flag(left.rlike(_SECRET_NEAR)),
        "harmless_near": flag(left.rlike(_HARMLESS_NEAR)),
        "prefix": flag(value.rlike(f"^(?:{_PREFIXES})")),
        "special": share(f"[^{_KEY}]"),
        "block": flag(value.startswith("-----BEGIN ")),
        "login": flag(left.rlike(_LOGIN + "$")),
    }


def labelled_findings(spark: SparkSession, rows: int = TRAINING) -> DataFrame:
    """(left, value, right, label): findings made by rule, half of them secrets."""
    i = F.col("id")
    digest = lambda salt: F.sha2(F.concat(F.lit(salt), i.cast("string")), 256)
    mixed_case = F.translate(F.base64(F.unhex(digest("m"))), "+/=", "_-0")
    pick = lambda salt, *options: F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(options))) + 1).cast("int"))
    size = (F.pmod(F.xxhash64(F.lit("n"), i), F.lit(25)) + 20).cast("int")
    prose = pick("p", "the value of ", "and then ", "in this section. ", "set it as ", "de la ", "mit der ", "see ")
    name = pick("k", "token", "api_key", "secret", "password", "auth_token", "access_key", "AWS_SECRET", "client_secret", "API-KEY", "passwd")
    sign = pick("s", ' = "', ": ", "=", "='", ' := "', " is ", '": "')
    close = F.when(sign.contains('"'), '" ').when(sign.contains("'"), "' ").otherwise(" ") if isinstance(sign, Column) else F.lit(" ")
    key = pick("v", digest("a").substr(F.lit(1), size), digest("b").substr(F.lit(1), F.lit(40)), mixed_case.substr(F.lit(1), size), F.concat(F.lit("AKIA"), F.upper(digest("c")).substr(F.lit(1), F.lit(16))), F.concat(F.lit("ghp_"), mixed_case.substr(F.lit(1), F.lit(36))))
    prefixed = pick("q", F.concat(F.lit("AKIA"), F.upper(digest("d")).substr(F.lit(1), F.lit(16))), F.concat(F.lit("ghp_"), mixed_case.substr(F.lit(1), F.lit(36))), F.concat(F.lit("sk_live_"), mixed_case.substr(F.lit(1), F.lit(24))), F.concat(F.lit("xoxb-"), mixed_case.substr(F.lit(1), F.lit(30))))
    number = F.translate(digest("e"), "abcdef", "482915")
    part = digest("u")
    uuid = F.concat_ws("-", part.substr(F.lit(1), F.lit(8)), part.substr(F.lit(9), F.lit(4)), part.substr(F.lit(13), F.lit(4)), part.substr(F.lit(17), F.lit(4)), part.substr(F.lit(21), F.lit(12)))
    word = pick("w", "example", "sample_user", "your-token", "test_value", "image-file", "the_index", "placeholder", "build-version")
    harmless = [
        (prose, number.substr(F.lit(1), F.lit(16)), F.lit(" and")),
        (F.concat(prose, pick("h", "sha256: ", "md5 ", "checksum=", "commit ", "etag: ")), pick("x", digest("f"), digest("g").substr(F.lit(1), F.lit(40)), digest("h").substr(F.lit(1), F.lit(32))), F.lit(" ok")),
        (F.concat(prose, pick("i", "uuid ", "id: ", "", "guid=")), uuid, F.lit(", ")),
        (pick("j", "https://www.example.com/", "./", "/usr/lib/"), F.concat(word, F.lit("/"), digest("i").substr(F.lit(1), F.lit(8)), F.lit("/index")), F.lit(".html")),
        (F.concat(name, sign), F.concat(word, F.lit("_"), word, number.substr(F.lit(1), F.lit(4))), close),
        (prose, F.concat(word, F.lit("-"), number.substr(F.lit(1), F.lit(6)), F.lit("_"), word), F.lit(" ")),
        (F.concat(prose, F.lit("base64,")), F.base64(F.unhex(digest("z"))), F.lit(" ")),
        (F.concat(prose, pick("o", "order ", "card ", "phone: ", "serial ")), number.substr(F.lit(1), F.lit(18)), F.lit(".")),
    ]
    letters = F.translate(digest("l"), "0123456789abcdef", "bcdflmnrstvaeiou")
    few = (F.pmod(F.xxhash64(F.lit("few"), i), F.lit(9)) + 7).cast("int")
    phrase = letters.substr(F.lit(1), few + 9)
    signs = pick("y", "$", "!", "#", "@", "%", "&", "*")
    password = pick("r", mixed_case.substr(F.lit(1), few), F.concat(letters.substr(F.lit(1), F.lit(5)), number.substr(F.lit(1), F.lit(3)), letters.substr(F.lit(9), F.lit(3))), F.concat(F.initcap(letters.substr(F.lit(1), F.lit(3))), signs, mixed_case.substr(F.lit(3), F.lit(4)), pick("Y", "!", "?", "."), number.substr(F.lit(1), F.lit(2))), phrase)
    bare = F.translate(mixed_case, "0123456789", "kQwXzJvBnR").substr(F.lit(1), size)
    address = F.concat(prose, pick("a", "postgres://", "https://", "mysql://", "amqp://", "redis://"), pick("A", "root", "app", "u", "svc_user", "admin"), F.lit(":"))
    block = F.concat(F.lit("-----BEGIN "), pick("b", "RSA ", "", "EC ", "OPENSSH "), F.lit("PRIVATE KEY-----\n"), F.base64(F.unhex(F.concat(digest("B"), digest("C")))), F.lit("\n"), F.base64(F.unhex(digest("D"))), F.lit("\n-----END PRIVATE KEY-----"))
    held = F.concat(prose, name, sign)
    secret = [(held, key, close), (held, key, close), (prose, prefixed, F.lit(" ")), (held, password, close), (held, password, close), (held, bare, close), (address, pick("P", password, key), F.lit("@db.host/x")), (prose, block, F.lit("\n")), (prose, F.concat(F.lit("AKIA"), F.upper(letters).substr(F.lit(1), F.lit(16))), F.lit(" "))]
    setting = pick("S", "required", "optional", "string", "undefined", "changeme", "your_password_here", "example", "process.env.TOKEN", "os.environ", "settings.SECRET_KEY", "config.token", "the-password", "invalid", "missing", "expired", "disabled", "${TOKEN}", "<your-token>", "self.token", "request.headers", "none_given", "my_secret_name")
    camel = F.concat(pick("1", "get", "set", "current", "default"), F.initcap(pick("2", "user", "client", "token", "session", "page")), F.initcap(pick("3", "name", "value", "index", "data")), F.initcap(pick("4", "handler", "manager", "factory", "from", "with")), pick("5", "Config", "Request", "Settings", "Test", ""))
    harmless += [(held, setting, close), (held, setting, close), (held, camel, close), (prose, camel, F.lit("(")), (address, pick("Q", "password", "pass", "secret", "changeme", "your-password", "$PASSWORD"), F.lit("@host/x"))]
    options = [[F.struct(a.alias("left"), b.alias("value"), c.alias("right")) for a, b, c in made] for made in (harmless, secret)]
    label = F.pmod(F.xxhash64(F.lit("t"), i), F.lit(2)).cast("int")
    chosen = F.when(label == 0, pick("0", *options[0])).otherwise(pick("0", *options[1]))
    return spark.range(0, rows, 1, 4).select(chosen.alias("f"), label.cast("double").alias("label")).select("f.*", "label")


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """A forest fitted to labelled findings."""
    made = features(F.col("left"), F.col("value"), F.col("right"))
    rows = findings.select("label", *[c.alias(k) for k, c in made.items()])
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, minInstancesPerNode=4).fit(assembled)


def forest_sql(model, name: str) -> str:
    """SQL for the share of the forest's trees that vote for a secret, over the struct called name."""
    trees, stack = [], []
    for line in model.toDebugString.splitlines():
        line = line.strip()
        if m := re.match(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            stack.append(f"IF({name}.{FEATURES[int(m[2])]} <= {float(m[4])!r}D, " if m[1] == "If" else ", ")
        elif m := re.match(r"Predict: (\S+)", line):
            stack.append(f"{int(float(m[1]))}")
        elif line.startswith("Tree "):
            trees.append(stack := [])
    # An Else closes the If before it once its own branch ends.
    return "(" + " + ".join(_closed(t) for t in trees) + f") / {len(trees)}D"


def _closed(parts: list[str]) -> str:
    """The nested IF of a tree's parts in preorder."""
    out: list[str] = []

    def branch(at: int) -> int:
        if parts[at].startswith("IF("):
            out.append(parts[at])
            at = branch(at + 1)
            out.append(parts[at])
            at = branch(at + 1)
            out.append(")")
            return at
        out.append(parts[at])
        return at + 1

    branch(0)
    return "".join(out)


_FOREST: list[str] = []


def forest(spark: SparkSession) -> str:
    """The forest of the findings made by rule, as SQL over a struct f; the same in every session, so it is fitted once."""
    if not _FOREST:
        _FOREST.append(forest_sql(train(labelled_findings(spark)), "f"))
    return _FOREST[0]


def scan(docs: DataFrame, forest: str, text_col: str = "text", votes: float = VOTES) -> DataFrame:
    """(row, text, segments, parts, found): docs' columns as a struct, the text, what stands between its candidates, each
    candidate's (before, value), and its (ordinal, length, score, secret). forest is SQL over a struct f of features()."""
    rows = beside(docs, F.col(f"`{text_col}`").cast("string").alias("text"))
    text = F.coalesce("text", F.lit(""))
    split = lambda m: F.struct(F.regexp_extract(m, _BEFORE, 0).alias("before"), F.substring(m, F.length(F.regexp_extract(m, _BEFORE, 0)) + 1, F.length(m)).alias("value"))
    # Most texts have none of the signs, and then only runs are searched, which is several times as fast.
    more = F.lit(False)
    for sign in _SIGNS:
        more |= F.col("low").contains(sign)
    known = rows.withColumn("low", F.lower(text)).withColumn("more", more).drop("low")
    either = lambda f: F.when(F.col("more"), f(CANDIDATE)).otherwise(f(_RUNS))
    found = known.withColumns({"segments": either(lambda p: F.split(text, p, -1)), "matches": either(lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)))}).drop("more")
    taken = found.withColumn("parts", F.transform("matches", split)).drop("matches")
    around = lambda p, i: features(F.right(F.concat(F.right(F.get("segments", i), F.lit(CONTEXT)), p["before"]), F.lit(CONTEXT)), p["value"], F.left(F.get("segments", i + 1), F.lit(CONTEXT)))
    described = taken.withColumn("described", F.transform("parts", lambda p, i: F.struct(*[c.alias(k) for k, c in around(p, i).items()])))
    scored = described.withColumn("scores", F.expr(f"transform(described, f -> {forest})"))
    found = F.transform("scores", lambda s, i: F.struct(i.alias("ordinal"), F.length(F.get("parts", i)["value"]).alias("length"), s.alias("score"), (s >= votes).alias("secret")))
    return scored.withColumn("found", found).drop("described", "scores")


def redacted() -> Column:
    """The text of a scanned row with REPLACEMENT for each secret; null stays null."""
    put = F.transform("segments", lambda s, i: F.concat(s, F.coalesce(F.concat(F.get("parts", i)["before"], F.when(F.get("found", i)["secret"], REPLACEMENT).otherwise(F.get("parts", i)["value"])), F.lit(""))))
    return F.when(F.exists("found", lambda f: f["secret"]), F.array_join(put, "")).otherwise(F.col("text"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), forest(spark))
    secret = F.filter("found", lambda f: f["secret"])
    return rows.select(
        F.col("row.doc_id"),
        F.size("found").cast("long").alias("n_candidates"),
        F.size(secret).cast("long").alias("n_secrets"),
        F.array_join(F.transform(secret, lambda f: f["ordinal"].cast("string")), ",").alias("secret_ordinals"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"),
        F.sha2(F.coalesce(redacted(), F.lit("")), 256).alias("redacted_sha256"),
    )


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """docs with secrets replaced in text, and n_chars to match where there is such a column."""
    clean = scan(docs, forest(docs.sparkSession), text_col).withColumn("clean", redacted())
    changed = F.exists("found", lambda f: f["secret"])
    put = {text_col: F.col("clean")}
    if size_col in docs.columns:
        put[size_col] = F.when(changed, F.length("clean").cast(docs.schema[size_col].dataType)).otherwise(F.col("row")[size_col])
    return clean.select(*[put.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


QUERIES = {"op8_forest_secret_scan": op8}
