"""Personal data replaced by surrogates, in DataFrame functions only.

Detected: e-mail addresses, IPv4 addresses, payment cards (issuer prefix and
check digit must hold), phone numbers, social security numbers, and names that
follow a title; the parts of such a name also wherever they stand alone as words
in the same document.  Every part of a name is an entity, whatever its title or
place.  An entity's surrogate is drawn from a keyed digest of its kind and
normal form, so it's the same in every document: an e-mail regardless of case, a
phone or card regardless of its punctuation, a name with or without its title.
Surrogates keep the type (cards pass the check digit, phones are valid in form,
e-mails end in the reserved .example), the format (layout, case and length of
what they replace) and, for names, script and gender: a name's ending tells the
gender that the titles before it as a given name tell in the corpus (the more
frequent one; none or as many of both: an ending that tells none).

The table of all distinct entities (not documents) is taken from the corpus.
Collision checks: where two entities of a kind draw the same surrogate, or one
draws another's real value, all but one draw again, in rounds, until none is
left.  The surrogates are joined to the documents that hold the entities; texts
without a match aren't searched again.

The key is the caller's: without it nobody can tell surrogates' entities by
trying names.  The query and the stage take ``spark.llm.pii.key`` from the
session, or draw a key of their own that nobody keeps.

Defined cases: null text stays null; empty text stays empty; texts without
entities are unchanged to the byte; repeated rows get the same result; null ids
are told apart by their texts; an empty table stays empty; other columns,
whatever their names, pass through as given.  Texts of any length are searched
whole, with patterns that take no deeper recursion for longer texts; a name
after more than ``TITLES`` titles counts some of them as its parts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, release, table, text_of

ROUNDS = 40
#: Titles before a name, at most.
TITLES = 4

# Titles before a name, by the gender they tell.
MALE = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Signor", "Senhor", "господин", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Signora",
          "Senhora", "госпожа", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Doctor", "Prof", "Professor", "Doktor", "Docteur", "Professeur", "Doctora", "Profesora", "доктор", "Доктор", "профессор", "Профессор")
TITLE = rf"(?:{'|'.join(MALE + FEMALE + NEUTRAL)})"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?=[A-Za-z0-9-])[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]{2,}"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PHONE = (r"(?<![0-9A-Za-z])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
         r"|\+(?:[0-9][ ./-]?|\([0-9]{1,4}\)[ ./-]?){7,14}[0-9])(?![0-9A-Za-z])")  # else with a country code: 8 to 15 digits
_PART = r"\p{Lu}[\p{L}'-]*\p{L}(?<!'s)"
NAME = rf"\b{TITLE}\.?(?:[ ]{TITLE}\.?){{0,{TITLES - 1}}}(?:[ ]{_PART}){{1,3}}"
ANY = f"{EMAIL}|{IP}|{CARD}|{SSN}|{PHONE}|(?U){NAME}"
#: What a text with an entity has; others aren't searched.
HINT = f"[0-9@]|{TITLE}[. ]"
ISSUER = "^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"

KINDS = ("email", "ip", "card", "ssn", "phone", "person")
ENTITY = "struct<kind:string,core:string,female:boolean,male:boolean>"
LATIN = ("bcdfghjklmnprstvz", "aeiou", "a", "n")
CYRILLIC = ("бвгдзклмнпрстфхш", "аеиоу", "а", "н")
GREEK = ("βγδζθκλμνπρστφχ", "αεηιο", "α", "ς")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))


def _luhn(digits: Column, upto: int = 0) -> Column:
    """Sum of a digit string by the card rule; ``upto`` 1 if the check digit is still to come."""
    turned = _chars(F.reverse(digits))

    def value(c: Column, i: Column) -> Column:
        n = c.cast("int")
        return F.when((i + upto) % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    return F.aggregate(F.transform(turned, value), F.lit(0), lambda a, b: a + b)


def kind_of(s: Column) -> Column:
    """A match's kind; null: it only looks like one."""
    card = _digits(s).rlike(ISSUER) & F.length(_digits(s)).between(13, 19) & (_luhn(_digits(s)) % 10 == 0)
    return (F.when(s.contains("@"), "email").when(s.rlike(rf"^\p{{L}}"), "person").when(s.rlike(f"^{IP}$"), "ip")
            .when(s.rlike(f"^{SSN}$"), "ssn").when(s.rlike(f"^{CARD}$"), F.when(card, "card")).otherwise(F.lit("phone")))


def _titled(s: Column, titles: tuple[str, ...]) -> Column:
    return s.rlike(rf"^(?:{TITLE}\.?[ ]){{0,{TITLES - 1}}}(?:{'|'.join(titles)})[. ]")


def _name(s: Column) -> Column:
    """What follows the titles of a match."""
    return F.regexp_replace(s, rf"^(?:{TITLE}\.?[ ]){{1,{TITLES}}}(?=.)", "")


def cores_of(s: Column, kind: Column) -> Column:
    """The normal forms of a match's entities: one, or each part of a name."""
    core = (F.when(kind == "email", F.lower(s)).when(kind == "ip", s)
            .when(kind == "phone", F.regexp_replace(_digits(s), "^.*(?=[0-9]{10}$)", "")).otherwise(_digits(s)))
    return F.when(kind.isNull(), F.array().cast("array<string>")).when(kind == "person", F.split(_name(s), " ")).otherwise(F.array(core))


def entities_of(s: Column, kind: Column) -> Column:
    """array of a match's entities (kind, core), and whether a title tells a given name's gender."""
    of = F.when(kind == "person", "name").otherwise(kind)

    def entity(core: Column, i: Column, n: Column) -> Column:
        given = (kind == "person") & (i < n - 1)
        return F.struct(of.alias("kind"), core.alias("core"), (given & _titled(s, FEMALE)).alias("female"),
                        (given & ~_titled(s, FEMALE) & _titled(s, MALE)).alias("male"))

    return _bound(cores_of(s, kind), lambda cores: F.transform(cores, lambda c, i: entity(c, i, F.size(cores))))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it's used."""
    return F.transform(F.array(value), use)[0]


def surrogate(kind: Column, core: Column, gender: Column, draw: Column, key: str) -> Column:
    """An entity's surrogate in normal form: the letters and digits come from a keyed digest."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, core, draw.cast("string")), 512)

    def drawn(h: Column) -> Column:
        def n(i: Column | int) -> Column:
            return F.conv(F.substring(h, F.lit(2) * (i if isinstance(i, Column) else F.lit(i)) % 128 + 1, F.lit(2)), 16, 10).cast("int")

        def letter(alphabet: str, i: Column) -> Column:
            return F.substring(F.lit(alphabet), n(i) % len(alphabet) + 1, F.lit(1))

        def shaped(s: Column) -> Column:
            def pick(c: Column, i: Column) -> Column:
                return F.when(c.rlike("[0-9]"), (n(i) % 10).cast("string")).when(c.rlike("[a-z]"), letter("abcdefghijklmnopqrstuvwxyz", i)).otherwise(c)
            return F.array_join(F.transform(_chars(s), pick), "")

        def numbers(s: Column) -> Column:  # area and exchange of a phone begin with 2 to 9
            return F.array_join(F.transform(_chars(s), lambda c, i: F.when(
                (kind == "phone") & (i % 10).isin(0, 3), n(i) % 8 + 2).otherwise(n(i) % 10).cast("string")), "")

        def spelled(length: Column, script: tuple[str, str, str, str]) -> Column:
            consonants, vowels, female, male = script

            def pick(i: Column) -> Column:
                last = F.when(gender == "female", F.lit(female)).when(gender == "male", F.lit(male)).otherwise(letter(consonants, i))
                return F.when(i == length - 1, last).when(i % 2 == 0, letter(consonants, i)).otherwise(letter(vowels, i))

            return F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), length - 1), pick), ""))

        def name(s: Column) -> Column:
            scripts = ((r"\p{IsCyrillic}", CYRILLIC), (r"\p{IsGreek}", GREEK), ("", LATIN))
            return _bound(F.greatest(F.length(s), F.lit(4)) + (draw / 4).cast("int"),
                          lambda n: F.coalesce(*[F.when(s.rlike(p), spelled(n, script)) for p, script in scripts]))

        local, domain = F.substring_index(core, "@", 1), F.substring_index(core, "@", -1)
        host = F.regexp_replace(domain, r"\.[^.]*$", "")
        longer = F.concat(local, F.repeat(F.lit("x"), (draw / 4).cast("int")))
        body = F.concat(F.substring(core, 1, 1), numbers(core.substr(F.lit(2), F.length(core) - 2)))
        return (F.when(kind == "email", F.concat(shaped(F.concat(longer, F.lit("@"), host)), F.lit(".example")))
                .when(kind == "ip", F.concat_ws(".", (n(0) % 126 + 1).cast("string"), *[n(i).cast("string") for i in (1, 2, 3)]))
                .when(kind == "card", F.concat(body, ((F.lit(10) - _luhn(body, 1) % 10) % 10).cast("string")))
                .when(kind.isin("phone", "ssn"), numbers(core)).otherwise(name(core)))

    return F.transform(F.array(digest), drawn)[0]


def _laid_out(s: Column, digits: Column) -> Column:
    """``digits`` in place of the last digits of ``s``, punctuation kept."""
    skip = F.length(_digits(s)) - F.length(digits)

    def put(a: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        take = F.when(is_digit & (a["n"] >= skip), F.substring(digits, a["n"] - skip + 1, F.lit(1))).otherwise(c)
        return F.struct((a["n"] + is_digit.cast("int")).alias("n"), F.concat(a["out"], take).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))
    return F.aggregate(_chars(s), start, put, lambda a: a["out"])


def replaced(s: Column, kind: Column, surrogates: Column) -> Column:
    """What stands in the text for a match."""
    mail = F.when((F.upper(s) == s) & F.lower(s).rlike("[a-z]"), F.upper(surrogates[0])).otherwise(surrogates[0])
    return (F.when(kind.isNull(), s).when(kind == "email", mail).when(kind == "ip", surrogates[0])
            .when(kind == "person", F.concat(F.substring(s, F.lit(1), F.length(s) - F.length(_name(s))), F.array_join(surrogates, " ")))
            .otherwise(_laid_out(s, surrogates[0])))


def hits_of(text: Column) -> Column:
    """array<struct<s, kind>>: a text's matches, with null kinds where they only look like one."""
    none = F.array().cast("array<struct<s:string,kind:string>>")
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda s: F.struct(s.alias("s"), kind_of(s).alias("kind")))
    return F.when(text.rlike(HINT), found).otherwise(none)


def _all(hits: Column) -> Column:
    """All entities of a text's matches."""
    return F.flatten(F.transform(hits, lambda h: entities_of(h["s"], h["kind"])))


def drawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, core, s): the surrogates of the distinct entities (kind, core, gender), after all checks."""
    now, tables, done = entities.withColumn("draw", F.lit(0)), [], None
    for round_ in range(ROUNDS):
        last = tables[-1:]
        now = materialise(now.withColumn("s", surrogate(F.col("kind"), F.col("core"), F.col("gender"), F.col("draw"), key)), "surrogates")
        release(*last)
        tables.append(now)
        first = now.groupBy("kind", "s").agg(F.min(F.struct("draw", "core")).alias("w"))
        real = now.select("kind", F.col("core").alias("s"), F.lit(True).alias("real"))
        judged = now.join(first, ["kind", "s"]).join(real, ["kind", "s"], "left")
        lost = F.col("real").isNotNull() | (F.col("w.core") != F.col("core"))
        if judged.filter(lost).isEmpty():
            done = now.select("kind", "core", "s")
            break
        now = judged.select("kind", "core", "gender", F.when(lost, round_ + 1).otherwise(F.col("draw")).alias("draw"))
    if done is None:
        raise RuntimeError(f"surrogates still collide after {ROUNDS} draws: a kind has too many entities for its format")
    return done


def seen(docs: DataFrame, key: str) -> DataFrame:
    """(id, hash, known): the texts with matches, and their entities (kind, core) with surrogates s."""
    text = text_of()
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"), hits_of(text).alias("hits")).filter(F.size("hits") > 0)
    rows = materialise(rows.select("id", "hash", _all(F.col("hits")).alias("entities")).dropDuplicates(["id", "hash"]), "pii-entities")
    each = rows.select("id", "hash", F.explode("entities").alias("e")).select("id", "hash", "e.*")
    votes = each.groupBy("kind", "core").agg((F.count_if("female") - F.count_if("male")).alias("v"))
    gender = F.when(F.col("v") > 0, "female").when(F.col("v") < 0, "male").otherwise("neutral")
    told = drawn(votes.select("kind", "core", gender.alias("gender")), key)
    held = each.select("id", "hash", "kind", "core").distinct().join(told, ["kind", "core"])
    held = held.groupBy("id", "hash").agg(F.collect_list(F.struct("kind", "core", "s")).alias("known"))
    out = materialise(held, "pii-seen")
    release(rows)
    return out


def rewritten(text: Column, hits: Column, known: Column) -> Column:
    """The text with its matches, and its names' parts elsewhere, replaced by what ``known`` has for them."""
    def own(kind: Column, core: Column) -> Column:
        return F.filter(known, lambda d: (d["kind"] == kind) & (d["core"] == core))[0]["s"]

    def stand_in(h: Column) -> Column:
        of = F.when(h["kind"] == "person", "name").otherwise(h["kind"])
        return replaced(h["s"], h["kind"], F.transform(cores_of(h["s"], h["kind"]), lambda c: own(of, c)))

    names = F.transform(F.filter(known, lambda d: d["kind"] == "name"), lambda d: d["core"])
    longest = F.array_sort(names, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    part = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))

    def alone(gap: Column, part: Column) -> Column:
        met = F.struct(F.split(gap, part, -1).alias("around"), F.regexp_extract_all(gap, part, F.lit(0)).alias("met"))
        return _bound(met, lambda m: F.array_join(F.transform(
            m["around"], lambda x, i: F.when(i < F.size(m["met"]), F.concat(x, own(F.lit("name"), F.get(m["met"], i)))).otherwise(x)), ""))

    def gaps(part: Column) -> Column:
        around = F.split(text, ANY, -1)
        return F.when(F.size(names) > 0, F.transform(around, lambda g: alone(g, part))).otherwise(around)

    def joined(between: Column) -> Column:
        return F.array_join(F.transform(between, lambda g, i: F.when(
            i < F.size(hits), F.concat(g, stand_in(F.get(hits, i)))).otherwise(g)), "")

    return _bound(_bound(part, gaps), joined)


def pseudonymise(docs: DataFrame, key: str, hits: str | None = None) -> DataFrame:
    """``docs`` with each entity in ``text`` replaced; with ``hits``, a column of that name has the matches (s, kind)."""
    known = seen(docs.select("doc_id", "text"), key)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    # The texts with matches grow with the corpus: the join is by shuffles at every size.
    rows = rows.join(known.hint("merge"), F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("hash")), "left")
    none = F.array().cast("array<struct<s:string,kind:string>>")
    rows = rows.withColumn("hits", F.when(F.col("known").isNotNull(), hits_of(text)).otherwise(none))
    new = F.when(F.size("hits") > 0, rewritten(text, F.col("hits"), F.col("known"))).otherwise(F.col("row.text"))
    extra = [] if hits is None else [F.col("hits").alias(hits)]
    return rows.select(*[new.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns], *extra)


def key_of(spark: SparkSession) -> str:
    """The session's key, or a new one."""
    return spark.conf.get("spark.llm.pii.key", None) or uuid.uuid4().hex


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key_of(spark), "hits")

    def count(kind: str) -> Column:
        return F.size(F.filter("hits", lambda h: h["kind"] == kind)).cast("bigint")

    return rows.select("doc_id", "text", *[count(k).alias(f"n_{k}") for k in KINDS])
