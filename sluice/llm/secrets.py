"""Secret scan: candidates by shape, false positives removed by a random forest. No Python on the rows.

Candidates are of three kinds. Runs of 12 or more key characters with a digit, or of 16 capitals, anywhere in a
blank-separated token, so that JSON, query strings and lists give one for each value; quotes, an assignment and leading
names with a colon (``password:``) are not part of it, but of the text before. Values of ``SHORTEST`` characters or more of
any kind, letters alone and punctuation included, that are assigned to a credential's name in the same or the next tokens. And the
password in the user part of an address. A run within a path is not told from it. Features of a candidate: length, transitions
between character classes, shares of digits, capitals, hex digits, vowels and punctuation, distinct
characters, its segments and the longest of them, coverage by dictionary words and by words with a capital, parts of a path or
address, a known issuer's prefix, shapes of dates, versions, numbers and identifiers, and the neighbouring words (the ``NEAR``
characters before and after, however long a text is): credential names, names of checksums and revisions, of goods and their
numbers, words of examples, an assignment.

The forest is trained by ``pyspark.ml`` on labelled findings: a documented table (``FORMS``) of made-up keys and of
what looks like them, ``PER_FORM`` of each form, and those given, at most ``PER_CLASS`` of each label. No label is made from the
features. Its trees become one expression, so that documents are judged where they are: nothing is exploded,
joined or shuffled.

NULL and empty texts have no findings. Rows are kept, repeated ones too. Long texts and tokens are searched whole, in
linear time. A value that is found twice is two findings; all its places are masked. An empty table gives no findings; columns
with names of its own are left as they are.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import free_name, stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Documents without a match have no candidate.
HINT = r"[0-9]|[A-Z]{16}"
CREDENTIAL = r"passw|passphrase|pwd|secret|token|api[_\-]?key|access[_\-]?key|auth|credential|private"
#: Documents without a match have no candidate of any kind.
ANY = rf"{HINT}|(?i:{CREDENTIAL})|://"
CLASS = r"A-Za-z0-9+/_@.:\-"
#: Letters and up to three digits at their end, which is not what keys look like.
NAME = r"(?![A-Z]{16})[A-Za-z][A-Za-z_.\-]*+[0-9]{0,3}+"
ASSIGNED = r"[\"']?[A-Za-z0-9+/_\-]"
#: Possessive and only tried where a run starts: linear in the length of the token. Not a name that something is
#: assigned to; ``=`` ends a run unless something is assigned by it.
VALUE = (
    rf"(?<![{CLASS}])(?!{NAME}(?:[\"']?={ASSIGNED}|[\"']:))"
    rf"([{CLASS}]{{12,}}+(?:={{1,2}}+(?!{ASSIGNED}))?+)"
)
#: A run and what lies between it and the run before. Tried once from each end of a match, so linear too.
PIECE = rf"(?s)\G.*?{VALUE}"
#: Names before a value, unless they are the start of an address, of bytes in hex digits, or a key.
NAMED = rf"^(?![0-9A-Fa-f]{{2}}:[0-9A-Fa-f]{{2}}:)(?:{NAME}:(?!//)){{1,9}}+"
#: The fields of a token before the one whose name stands right before a value.
OTHERS = r"^.*[,;&?{(|](?=[\"']?[A-Za-z_][A-Za-z0-9_.\-]*[\"']?[=:]\W*$)"
#: What a credential's name assigns: up to a blank, a quote, a bracket, a comma or the next field of a query.
SHORTEST = 8
GIVEN = r"((?:[^\x00-\x20\"'`,;&<>(){}\[\]]|&(?![A-Za-z_][A-Za-z0-9_.\-]*=))++)"
NAMING = rf"(?i)(?:{CREDENTIAL})[A-Za-z0-9_.\-]*+[\"']?\]?"
ASSIGNING = rf"{NAMING}(?:=>|:=|==?|:)[\"'`]?"
#: The end of the words before a value that is assigned.
ASSIGNS = rf"{NAMING} ?(?:=>|:=|==?|:)$"
#: The password in the user part of an address.
USER = r"://[^/?#@:\x00-\x20\"']*+:([^/@\x00-\x20\"']++)@"
CHECKSUM = r"commit|\brev\b|sha[0-9]*|md5|crc|etag|hash|checksum|digest|fingerprint|revision|uuid|\bid\b|isbn|build|base64"
GOODS = r"part|model|serial|order|ticket|invoice|tracking|product|release|version|section|standard|article|catalog|\bno\b|number|iban|account"
EXAMPLE = r"example|sample|dummy|placeholder|test|fake|your"
#: Words that show that a candidate was written for people.
DICTIONARY = (
    "the and for with from this that have not are was you all can new one out use page index home about "
    "image file data http https html www com org net mail example user name date time news article post blog "
    "version test sample default config local server client service system public "
    "pro max plus mini ultra lite phone black white silver gold blue red green section part model series release "
    "stable beta alpha build linux windows android mobile desktop update report summary final draft copy backup archive "
    "photo video music song book chapter volume issue edition street road north south east west city river house water light "
    "green apple summer winter spring autumn morning evening night monday friday january march april june july august september "
    "value string number array object class method function return result request response header body length size count total "
    "first last next open close start stop left right true false null none required optional enabled disabled basic"
).split()
ISSUED = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$"
#: How issuers' keys start.
PREFIX = r"^(AKIA|ASIA|AIza|eyJ|xox[abprs]-|[a-z]{2,6}_live_|[a-z]{2,3}_test_|gh[pousr]_|[a-z]+_pat_|[a-z]{2,5}pat-|[a-z]{2,4}_(?=[A-Za-z0-9]{30})|[A-Z]{2}\.(?=[A-Za-z0-9_\-]{20})|sk-)"
#: Dates and times, dotted versions and numbers, grouped digits, UUIDs.
SHAPE = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}|^v?[0-9]+\.[0-9]+|^[+#]?[0-9][0-9\-./:]*$|"
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
)
#: Characters before and behind a candidate, of the neighbouring words, that its features look at.
NEAR = 100
NAMES = (
    "length transitions digits capitals hex distinct dictionary path address credential checksum example assigned "
    "vowels punctuation segments longest numbers words issuer shape goods named user"
).split()
TREES, DEPTH, SEED, PER_CLASS, CUT = 40, 10, 7, 2000, 0.5
MASK = "[SECRET]"


def with_candidates(df: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``df`` with an array of (position, value, before, after, features) in the column ``into``."""
    tokens = free_name(df, "tokens")
    words = F.when(F.col(text).rlike(ANY), F.split(F.col(text), BLANKS)).otherwise(F.array().cast("array<string>"))
    words = F.coalesce(words, F.array().cast("array<string>"))

    def word(x: Column, step: int) -> Column:
        return F.coalesce(F.get(F.col(tokens), x["position"] + step), F.lit(""))

    def runs(x: Column) -> Column:
        """The runs of a token, each with what lies before it in the token."""
        reach = NEAR // 12 + 1  # pieces before, of 12 characters at least

        def run(piece: Column, i: Column) -> Column:
            first = F.greatest(i - reach, F.lit(0))
            return F.struct(
                x["position"].alias("position"),
                F.regexp_extract(piece, rf"{VALUE}\z", 1).alias("run"),
                F.concat(
                    F.array_join(F.slice(x["pieces"], first + 1, i - first), ""),
                    F.regexp_replace(piece, rf"{VALUE}\z", ""),
                ).alias("start"),
                ((i == F.size(x["pieces"]) - 1) & x["ends"]).alias("ends"),
            )

        return F.transform(x["pieces"], run)

    def trimmed(x: Column) -> Column:
        value = F.regexp_replace(x["run"], r"(?<![.:\-])[.:\-]++$", "")
        return F.struct(*[x[c].alias(c) for c in ("position", "start", "ends")], value.alias("value"))

    def unnamed(x: Column) -> Column:
        rest = F.regexp_replace(x["value"], NAMED, "")
        return F.struct(
            *[x[c].alias(c) for c in ("position", "start", "ends", "value")],
            F.when((F.length(rest) >= 12) & rest.rlike(HINT), rest).otherwise(x["value"]).alias("rest"),
        )

    def detail(x: Column) -> Column:
        name = F.left(x["value"], F.length(x["value"]) - F.length(x["rest"]))
        start = F.regexp_replace(F.right(F.concat(x["start"], name), F.lit(NEAR)), OTHERS, "")
        return F.struct(
            x["position"].alias("position"),
            x["rest"].alias("value"),
            F.lower(
                F.right(F.concat_ws(" ", word(x, -2), word(x, -1), start), F.lit(NEAR))
            ).alias("before"),
            F.when(x["ends"], F.lower(F.left(word(x, 1), F.lit(NEAR)))).otherwise("").alias("after"),
        )

    placed = F.transform(F.col(tokens), lambda t, i: F.struct(i.alias("position"), t.alias("token")))
    likely = F.filter(placed, lambda x: (F.length(x["token"]) >= 12) & x["token"].rlike(HINT) & x["token"].rlike(VALUE))
    cut = F.transform(
        likely,
        lambda x: F.struct(
            x["position"].alias("position"),
            F.regexp_extract_all(x["token"], F.lit(PIECE), F.lit(0)).alias("pieces"),
            x["token"].rlike(rf"{VALUE}[^A-Za-z0-9]*+\z").alias("ends"),
        ),
    )
    values = F.transform(F.flatten(F.transform(cut, runs)), trimmed)
    values = F.filter(values, lambda x: (F.length(x["value"]) >= 12) & x["value"].rlike(HINT))
    found = F.transform(F.transform(values, unnamed), detail)

    def context(x: Column, value: Column, near: Column) -> Column:
        return F.struct(
            x["position"].alias("position"),
            value.alias("value"),
            F.lower(F.right(F.concat_ws(" ", word(x, -2), word(x, -1), near), F.lit(NEAR))).alias("before"),
            F.lower(F.left(word(x, 1), F.lit(NEAR))).alias("after"),
        )

    def given(x: Column) -> Column:
        """What is assigned within a token: the whole match with its name, which is the text before."""
        matches = F.regexp_extract_all(x["token"], F.lit(ASSIGNING + GIVEN), F.lit(0))
        return F.transform(
            matches,
            lambda m: context(x, closed(F.regexp_extract(m, ASSIGNING + GIVEN, 1)), F.regexp_extract(m, ASSIGNING, 0)),
        )

    def closed(value: Column) -> Column:
        return F.regexp_replace(value, r"(?<![.:])[.:]++$", "")

    def passwords(x: Column) -> Column:
        matches = F.regexp_extract_all(x["token"], F.lit(USER), F.lit(1))
        return F.transform(matches, lambda m: context(x, m, F.lit("://user:")))

    # Runs are found as such. All else that is assigned: within its token, behind it, in an address.
    fresh = lambda x: (F.length(x["value"]) >= SHORTEST) & ~(
        x["value"].rlike(rf"^[{CLASS}]{{12,}}+={{0,2}}$") & x["value"].rlike(HINT)
    )
    naming = F.filter(placed, lambda x: x["token"].rlike(ASSIGNING))
    behind = F.filter(
        placed,
        lambda x: (F.length(x["token"]) >= SHORTEST) & F.right(F.concat_ws(" ", word(x, -2), word(x, -1)), F.lit(NEAR)).rlike(ASSIGNS),
    )
    next_value = F.transform(behind, lambda x: context(x, closed(F.regexp_extract(x["token"], rf"^[\"'`]?{GIVEN}", 1)), F.lit("")))
    addressed = F.filter(placed, lambda x: x["token"].rlike(USER))
    none = F.array().cast("array<struct<position:int,value:string,before:string,after:string>>")
    named = F.col(text).rlike(rf"(?i:{CREDENTIAL})")
    assigned = F.concat(F.flatten(F.transform(naming, given)), next_value)
    found = F.concat(
        found,
        F.when(named, F.filter(assigned, fresh)).otherwise(none),
        F.when(F.col(text).contains("://"), F.filter(F.flatten(F.transform(addressed, passwords)), lambda x: F.length(x["value"]) >= 6)).otherwise(none),
    )
    whole = F.transform(
        found,
        lambda x: F.struct(
            x["position"].alias("position"),
            x["value"].alias("value"),
            x["before"].alias("before"),
            x["after"].alias("after"),
            features(x["value"], x["before"], x["after"]).alias("features"),
        ),
    )
    return df.withColumn(tokens, words).withColumn(into, whole).drop(tokens)


def features(value: Column, before: Column, after: Column) -> Column:
    length = F.length(value).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / length

    def told(condition: Column) -> Column:
        return condition.cast("double")

    runs = F.regexp_count(value, F.lit(r"[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"))
    known = F.regexp_replace(F.lower(value), "|".join(sorted(set(DICTIONARY), key=len, reverse=True)), "")
    segments = F.transform(F.regexp_extract_all(value, F.lit(r"[A-Za-z0-9]+"), F.lit(0)), lambda x: F.length(x))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    return F.array(
        length,
        (runs - 1) / length,
        share("[^0-9]"),
        share("[^A-Z]"),
        share("[^0-9a-f]"),
        F.size(F.array_distinct(F.split(value, ""))) / length,
        1 - F.length(known) / length,
        F.regexp_count(value, F.lit(r"/")).cast("double"),
        told(value.rlike(r"@|\.[a-z]{2,}|^[0-9]+\.|://|^www\.")),
        told(before.rlike(CREDENTIAL)),
        told(before.rlike(CHECKSUM)),
        told(before.rlike(EXAMPLE) | after.rlike(EXAMPLE) | F.lower(value).rlike(EXAMPLE)),
        told(before.rlike(r"[=:]\W*$")),
        share("[^aeiouAEIOU]") * length / F.greatest(letters, F.lit(1)),
        share("[A-Za-z0-9]"),
        F.size(segments).cast("double"),
        F.coalesce(F.array_max(segments), F.lit(0)).cast("double"),
        F.regexp_count(value, F.lit("[0-9]+")) / length,
        1 - F.length(F.regexp_replace(value, "[A-Z]?[a-z]{3,}", "")) / length,
        told(value.rlike(PREFIX)),
        told(value.rlike(SHAPE)),
        told(before.rlike(GOODS)),
        told(before.rlike(rf"({CREDENTIAL})[a-z0-9_.\-]*[\"']?\]? ?(?:=>|:=|==?|:)[ \"'`]*$")),
        told(before.rlike(r"://user:$")),
    )


def presumed(value: Column, before: Column) -> Column:
    """The label of findings that are certain by format or context, to look at; NULL for the others."""
    assigned = before.rlike(rf"({CREDENTIAL})\w*\W*[=:]\W*$")
    address = value.rlike(r"@|://|^www\.|^[0-9.:+\-/]+$")
    return (
        F.when(address | (before.rlike(CHECKSUM) & ~assigned), 0)
        .when(value.rlike(ISSUED) | assigned, 1)
        .cast("int")
    )


def findings(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All candidates of all documents, one row each, with their presumed label."""
    # Not a plain explode: Spark would look for empty arrays by making all candidates, and splitting texts, again.
    rows = with_candidates(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "found")
    rows = rows.select("doc_id", F.explode_outer("found").alias("x")).where("x IS NOT NULL").select("doc_id", "x.*")
    return rows.withColumn("label", presumed(F.col("value"), F.col("before")))


#: Made-up labelled findings, the key or look-alike in its sentence: 1 has a secret, between < and >. In braces, with their lengths: ``h`` hex digits,
#: ``u`` capitals and digits, ``c`` capitals, ``a`` letters of both cases and digits, ``l`` small letters, ``p`` all of these and
#: punctuation, ``d`` digits; ``w`` and ``W`` an ordinary word, the second one with a capital.
FORMS = (
    (1, "use <AKIA{u:16}> to"),
    (1, "key <ASIA{u:16}> of"),
    (1, "with <ghp_{a:36}> set"),
    (1, "has <gho_{a:36}> in"),
    (1, "bot <xoxb-{d:11}-{d:11}-{a:24}> is"),
    (1, "pay <sk_live_{a:24}> on"),
    (1, "map <AIza{a:35}> for"),
    (1, "cookie <eyJ{a:17}.eyJ{a:40}.{a:43}> sent"),
    (1, "password=<{h:18}> and"),
    (1, "password=<{a:14}> then"),
    (1, "passwd: <{p:12}> or"),
    (1, "DB_PASSWORD=<{a:20}> in"),
    (1, "user_password=<{p:16}> is"),
    (1, "pwd=<{l:14}> for"),
    (1, "password=<{w}{w2}{w3}> here"),
    (1, "password: <{w}{w2}{d:4}> here"),
    (1, "root_pwd = '<{p:11}>' now"),
    (1, "passphrase: \"<{w}-{w2}-{w3}-{w4}>\" of"),
    (1, "token = \"<{h:40}>\" then"),
    (1, "access_token=<{a:40}> by"),
    (1, "export TOKEN=<{a:24}> first"),
    (1, "api_key: <{u:16}{h:16}> for"),
    (1, "{{\"api_key\":\"<{a:32}>\",\"user\":\"{w}\"}} as"),
    (1, "secret=<{u:16}/{h:20}> here"),
    (1, "client_secret: <{a:32}> of"),
    (1, "secret_key_base: <{h:64}> in"),
    (1, "AWS_SECRET_ACCESS_KEY=<{a:40}> set"),
    (1, "Authorization: Bearer <{a:40}> goes"),
    (1, "call https://api.{w}.org/v1?token=<{h:20}>&user={w2} now"),
    (1, "at postgres://{w}:<{a:12}>@{w2}.org/{w3} is"),
    (1, "at mysql://root:<{p:12}>@10.0.0.{d:2}:3306 is"),
    (1, "at amqp://{w}:<{l:10}>@{w2}:5672/ is"),
    (0, "at commit {h:40} we"),
    (0, "sha256 {h:64} of"),
    (0, "checksum: {h:32} file"),
    (0, "etag {h:32} from"),
    (0, "uuid {h:8}-{h:4}-{h:4}-{h:4}-{h:12} is"),
    (0, "see {h:8}-{h:4}-4{h:3}-{h:4}-{h:12} in"),
    (0, "mail u{h:6}.42@mail8.example.com to"),
    (0, "mail {w}.{w2}{d:2}@{w3}.org to"),
    (0, "the 10.{d:2}.57.238:8080 and"),
    (0, "card {d:16} is"),
    (0, "account DE{d:20} of"),
    (0, "see https://www.example.com/page/{d:8}/{h:8} for"),
    (0, "see https://{w}.org/{w2}/{d:6}-{w3}-{w4} for"),
    (0, "in images/file/post_{d:8}.png of"),
    (0, "in /usr/share/{w}/{w2}-{d:1}.{d:2}/{w3}.conf of"),
    (0, "{w}_{w2}_{d:8}.tar.gz in"),
    (0, "on 2024-01-{d:2}T03:04:05.{d:3} the"),
    (0, "call 555-{d:4}-{d:4} or"),
    (0, "your example key {u:16}{d:4} goes"),
    (0, "the part {c:2}-{d:5}-{c:4} fits"),
    (0, "part number {c:3}{d:4}-{c:5} fits"),
    (0, "a {c:4}-{d:3}-{c:3}{d:2} with"),
    (0, "the {W}{d:2}{W2}{d:3}GB is"),
    (0, "an {l:1}{W}{d:2}{W2}{W3} has"),
    (0, "model {W}{c:2}{d:4}{W2} of"),
    (0, "B0{u:8}-{W} in"),
    (0, "release v{d:1}.{d:2}.{d:1}-rc{d:1}-build{d:5} is"),
    (0, "ISO-{d:4}-{d:1}:2015 says"),
    (0, "DIN{d:5}-part{d:1} says"),
    (0, "serial {u:12} of"),
    (0, "tracking 1Z{u:16} of"),
    (0, "order {c:2}{d:10} of"),
    (0, "user {w}{w2}{d:4} wrote"),
    (0, "class {W}{W2}{W3}{d:1} has"),
    (0, "in {w}_{w2}_{w3}{d:1} of"),
    (0, "at 52.{d:6},13.{d:6} near"),
    (0, "ratio {d:3}.{d:4}/{d:5}.{d:3} of"),
    (0, "img data:image/png;base64,{a:60} of"),
    (0, "the secret: {w} {w2} is"),
    (0, "a token: {w}{l:3} or"),
    (0, "password: required for"),
    (0, "password: {l:3}ing {w}"),
    (0, "token=request.headers and"),
    (0, "token = {w}_{w2} in"),
    (0, "password={w}.{w2} in"),
    (0, "auth: disabled for"),
    (0, "password=yourpassword{d:1} or"),
    (0, "secret=example{w}{d:2} or"),
    (0, "password=$DB_PASSWORD in"),
    (0, "token: string{d:1} of"),
)
#: Ordinary words for the forms.
ORDINARY = (
    "river garden window letter market summer bridge castle forest planet silver doctor farmer kitchen mountain ocean pencil "
    "rabbit school teacher valley winter yellow basket candle dragon engine flower guitar hammer island jacket ladder monkey "
    "needle orange pepper rocket saddle tunnel violin wagon copper button cotton desert finger harbor helmet"
).split()
PER_FORM = 60


def slots(seed: Column) -> dict[str, Column]:
    """Characters of each kind, made from a text; the same for the same text."""
    digest = F.sha2(seed.cast("binary"), 256)
    more = F.concat(digest, F.sha2(F.concat(seed, F.lit("+")).cast("binary"), 256))
    mixed = F.regexp_replace(F.base64(F.unhex(more)), "[+/=]", "")
    kinds = {
        "h": more,
        "u": F.upper(F.translate(F.reverse(more), "01234", "ghjkm")),
        "c": F.upper(F.translate(more, "0123456789", "ghkmnprtwx")),
        "d": F.translate(more, "abcdef", "314159"),
        "a": mixed,
        "l": F.translate(more, "0123456789", "lonrstiugh"),
        "p": F.translate(mixed, "ABCDEFGHJKLMN", "!$%#*+!$%?#~^"),
    }
    words = F.array(*[F.lit(word) for word in ORDINARY])
    for number in ("", "2", "3", "4"):
        word = F.get(words, F.pmod(F.xxhash64(seed, F.lit(number)), F.lit(len(ORDINARY))).cast("int"))
        kinds |= {f"w{number}": word, f"W{number}": F.initcap(word)}
    return kinds


def filled(form: str, kinds: dict[str, Column]) -> Column:
    pieces = []
    for piece in re.split(r"(\{\w\d?(?::\d+)?\})", form):
        slot = re.fullmatch(r"\{(\w\d?)(?::(\d+))?\}", piece)
        if slot:
            part = kinds[slot[1]]
            pieces.append(F.substring(part, 1, int(slot[2])) if slot[2] else part)
        else:
            pieces.append(F.lit(piece.replace("{{", "{").replace("}}", "}")))
    return F.concat(*pieces)


def made_up(spark: SparkSession, forms=FORMS, per_form: int = PER_FORM) -> DataFrame:
    """``form``, ``text``, ``secret``: sentences with a secret, or with what looks like one (NULL), the same
    in each run."""
    listed = F.array(*[F.lit(form) for _, form in forms])
    rows = spark.range(per_form, numPartitions=1).select("id", F.explode(listed).alias("form"))
    made = slots(F.concat(F.col("id").cast("string"), F.lit(" "), F.col("form")))
    # Stored, so that the forms name columns instead of holding how these are made.
    rows = stored(rows.select("form", *[value.alias(f"slot_{i}") for i, value in enumerate(made.values())]))
    kinds = {name: F.col(f"slot_{i}") for i, name in enumerate(made)}
    text = secret = F.lit(None).cast("string")
    for label, form in forms:
        here = F.col("form") == form
        text = F.when(here, filled(re.sub("[<>]", "", form), kinds)).otherwise(text)
        if label:
            secret = F.when(here, filled(form.split("<")[1].split(">")[0], kinds)).otherwise(secret)
    return rows.select("form", text.alias("text"), secret.alias("secret"))


def exemplars(spark: SparkSession, per_form: int = PER_FORM) -> DataFrame:
    """The labelled findings of ``FORMS``: candidates that are the secret, and all of sentences without one."""
    found = with_candidates(stored(made_up(spark, FORMS, per_form)), "found")
    found = found.select("secret", F.explode_outer("found").alias("x")).where("x IS NOT NULL")
    label = F.when(F.col("secret").isNull(), 0).when(F.col("x.value") == F.col("secret"), 1).cast("int")
    found = found.select(label.alias("label"), "x.features", "x.value", "x.before")
    return found.where("label IS NOT NULL")


def forest(spark: SparkSession) -> list[str]:
    """The forest of the made-up findings alone."""
    none = spark.createDataFrame([], "features array<double>, value string, before string, label int")
    return train(none)


def train(labelled: DataFrame, per_class: int = PER_CLASS) -> list[str]:
    """The trees of a forest trained on ``features`` and ``label`` (0 or 1) of the findings and the
    exemplars, as the lines in which Spark describes them."""
    order = [F.xxhash64("features", "value"), F.col("value"), F.col("before")]
    parts = [labelled.where(F.col("label") == label).orderBy(*order).limit(per_class) for label in (0, 1)]
    columns = [F.col("label").cast("double").alias("label"), "features"]
    rows = parts[0].unionAll(parts[1]).select(columns).unionAll(exemplars(labelled.sparkSession).select(columns))
    rows = stored(rows.orderBy("label", "features").coalesce(1))  # twice per_class and the exemplars at most
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector")
    return forest.fit(rows.withColumn("vector", array_to_vector("features"))).toDebugString.splitlines()


def votes(lines: list[str], features: Column) -> Column:
    """The share of trees that vote for a secret."""
    lines, trees = [line.strip() for line in lines[1:]], []

    def grow() -> Column:
        line = lines.pop(0)
        if line.startswith("Predict:"):
            return F.lit(float(line.split()[1]))
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        below = grow()
        lines.pop(0)  # Else
        return F.when(features[int(feature)] <= float(limit), below).otherwise(grow())

    while lines:
        if lines.pop(0).startswith("Tree"):
            trees.append(grow())
    return sum(trees[1:], trees[0]) / float(len(trees))


def judged(df: DataFrame, forest: list[str], into: str, text: str = "text") -> DataFrame:
    """``df`` with an array of (position, value, score) of all candidates in the column ``into``."""
    found = free_name(df, f"{into}_found")

    scored = F.transform(
        F.col(found),
        lambda x: F.struct(x["position"].alias("position"), x["value"].alias("value"), votes(forest, x["features"]).alias("score")),
    )
    return with_candidates(df, found, text).withColumn(into, scored).drop(found)


def scan(df: DataFrame, forest: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``position`` (token, from 0), ``value``, ``score``, ``is_secret`` of every candidate."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = judged(rows, forest, "found").select("doc_id", F.explode_outer("found").alias("x")).where("x IS NOT NULL")
    return rows.select("doc_id", "x.*", (F.col("x.score") >= CUT).alias("is_secret"))


def redact(df: DataFrame, forest: list[str], text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``df`` in its own columns with ``MASK`` for every secret; ``n_chars``, if there is such a
    column, becomes the new length where the text changed."""
    name, old = free_name(df, "findings"), F.col(text)
    bad = F.transform(F.filter(F.col(name), lambda x: x["score"] >= CUT), lambda x: x["value"])
    # Longer values first: one may be part of another.
    bad = F.reverse(F.array_sort(F.transform(F.array_distinct(bad), lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))
    new = F.aggregate(bad, old, lambda rest, x: F.replace(rest, x["v"], F.lit(MASK)))
    rows = judged(df, forest, name, text).withColumn(name, F.when(F.size(F.filter(name, lambda x: x["score"] >= CUT)) > 0, new))
    columns = []
    for column, kind in df.dtypes:
        if column == text:
            columns.append(F.coalesce(F.col(name), old).alias(column))
        elif column == n_chars:
            columns.append(F.when(F.col(name).isNotNull(), F.length(name)).otherwise(F.col(column)).cast(kind).alias(column))
        else:
            columns.append(F.col(f"`{column}`"))
    return rows.select(columns)
