"""Surrogates for personal data (built-in functions only).

Emails, phone numbers, payment cards, IP addresses, national ids, IBANs and
names after a title are found by one pattern in the whole text. Each distinct
entity, in a canonical form (lower case; digits alone), gets one surrogate drawn
from a keyed hash: the same kind, script, letter case, gender and punctuation;
country prefixes, a card's first digit and a valid check digit are kept up.

Coreference: the surrogate belongs to the canonical form, so every spelling of
one number, and a surname with or without its given name, stay one entity. A given
name's gender is what its titles in the whole corpus agree on, else neutral; it forms
the surrogate and is no part of the entity. In a document that names a person after a
title, the same words with a capital letter are replaced wherever else they stand.
Distinctness: surrogates are checked over the whole corpus; where two entities
meet in one surrogate, or a surrogate is itself an entity of the corpus, all but
the smallest entity draw again until no clash is left. After some draws
letters-and-digits surrogates grow longer, so that short forms cannot run out.

Defined results: null text stays null; texts without entities are unchanged;
rows equal in id and text get equal results; null ids are allowed; an empty table
gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import computed, durable, fresh, whole_text
from strata.session import shuffle_partitions

# What entities look like.
WORD = r"[\p{L}\p{N}._%+-]"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
EMAIL = rf"(?<!{WORD}){WORD}++@(?:[\p{{L}}\p{{N}}-]+\.)+\p{{L}}{{2,}}"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
PHONE = (r"(?<![\d+])\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
         r"|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,5}){2,5}(?!\d)|(?<![\d+])\+\d{8,15}(?!\d)"
         r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])")
CARD = r"(?<![\p{L}\p{N}+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])"
NATIONAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7} ?[A-Z0-9]{1,4}(?![\p{L}\p{N}])"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Don|Signor|Господин|Г-н|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|Signora|Госпожа|Г-жа|Κυρία"
NEUTRAL = "Dr|Prof"
NAME = (rf"(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})\.? "
        r"\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?")
MENTION = r"(?<!\p{L})\p{Lu}[\p{L}'-]+"
KINDS = {"email": EMAIL, "ip": IP, "iban": IBAN, "national": NATIONAL, "card": CARD,
         "phone": PHONE, "name": NAME}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
# Sixteen letters for each script, and name syllables and endings.
LATIN, CYRILLIC, GREEK = "bcdfghklmnprstae", "бвгдзклмнпрстаео", "βγδζκλμνπρστφαεο"
SYLLABLES = {
    "latin": "ba be bo da de do la le lo ma me mi na ne ro va".split(),
    "cyrillic": "ба бе бо да де до ла ле ло ма ме ми на не ро ва".split(),
    "greek": "βα βε βο δα δε δο λα λε λο μα με μι να νε ρο φα".split(),
}
ENDINGS = {
    ("latin", "male"): "rt ck n rd s l m ld x st nd tt rk us an er".split(),
    ("latin", "female"): "na la ra ia sa ta lia ria nia da ella ina ette isa lina rosa".split(),
    ("latin", "any"): "berg son mann ford well ley ton ner ström field dale hart wood mont ville ros".split(),
    ("cyrillic", "male"): "н р м л слав мир й с к т в рд н м ль ил".split(),
    ("cyrillic", "female"): "на ла ра ия са та лия рия ния да элла ина этта иса лина роза".split(),
    ("cyrillic", "any"): "енко ский ов ев ин ук ко ич ец як ль ман сон берг вич ар".split(),
    ("greek", "male"): "ς ος ης ας νος ρος κος λος τος μος ων ων ιος ευς ξ ρ".split(),
    ("greek", "female"): "α η ια να ρα λα τα σα ινα ελα ισα ουλα ω ιδα ανα ονα".split(),
    ("greek", "any"): "ίδης όπουλος άκης έας άτος ιανός ούδης έλης ώνης άρας ίου ου ής άς ός ίτης".split(),
}
GROW_AFTER = 6


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _kind(surface: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        whole = surface.rlike(rf"^(?:{pattern})$")
        out = F.when(whole, F.lit(name)) if out is None else out.when(whole, F.lit(name))
    return out


def _parts(surface: Column, kind: Column) -> Column:
    """(kind, canonical form, surface, gender) of an entity's parts; a name has its
    title (kept), its given name and its surname."""
    words = F.split(surface, " ")
    title = F.regexp_replace(F.get(words, 0), r"\.$", "")
    gender = (F.when(title.rlike(f"^(?:{MALE})$"), "male")
              .when(title.rlike(f"^(?:{FEMALE})$"), "female"))

    def part(k: Column, canon: Column, shown: Column, of: Column = F.lit(None)) -> Column:
        return F.struct(k.alias("kind"), canon.alias("canon"), shown.alias("shown"),
                        of.cast("string").alias("gender"))

    keep = part(F.lit("keep"), F.lit(""), F.get(words, 0))
    given = part(F.lit("given"), F.lower(F.get(words, 1)), F.get(words, 1), gender)
    last = part(F.lit("surname"), F.lower(F.element_at(words, -1)), F.element_at(words, -1))
    plain = F.when(kind == "email", F.lower(surface)).when(kind == "ip", surface) \
        .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit(""))).otherwise(_digits(surface))
    return (F.when(kind != "name", F.array(part(kind, plain, surface)))
            .when(F.size(words) > 2, F.array(keep, given, last)).otherwise(F.array(keep, last)))


def _digest(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """256 hexadecimal digits of a keyed hash."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"),
                                         F.lit(str(i))), 256) for i in range(4)])


def _spell(text: Column, number: Column, letters: Column, backward: bool = False) -> Column:
    """Every digit and letter drawn anew, in its own script and case. ``letters``
    holds the drawn letters of the three scripts."""
    def draw(c: Column, i: Column) -> Column:
        at = (F.lit(256) - F.pmod(i, F.lit(256))) if backward else F.pmod(i, F.lit(256)) + 1
        small = (F.when(c.rlike(r"\p{IsCyrillic}"), F.substring(letters["cyrillic"], at, 1))
                 .when(c.rlike(r"\p{IsGreek}"), F.substring(letters["greek"], at, 1))
                 .otherwise(F.substring(letters["latin"], at, 1)))
        return (F.when(c.rlike(r"\d"), F.substring(number, at, 1))
                .when(c.rlike(r"\p{Lu}"), F.upper(small)).when(c.rlike(r"\p{L}"), small)
                .otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), draw), "")


def _luhn_sum(number: Column, last: bool) -> Column:
    """Luhn sum of a digit string, with or without its check digit."""
    back = F.reverse(number)
    off = 1 if last else 0

    def add(a: Column, i: Column) -> Column:
        d = F.substring(back, i + 1, 1).cast("int") * F.when((i + off) % 2 == 0, 2).otherwise(1)
        return a + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add)


def _in_script(canon: Column, cyrillic: Column, greek: Column, latin: Column) -> Column:
    return (F.when(canon.rlike(r"\p{IsCyrillic}"), cyrillic)
            .when(canon.rlike(r"\p{IsGreek}"), greek).otherwise(latin))


def _name(canon: Column, gender: Column, digest: Column) -> Column:
    def syllable(table: list[str], at: int) -> Column:
        return F.get(F.array(*map(F.lit, table)),
                     F.conv(F.substring(digest, at, 1), 16, 10).cast("int"))

    def word(script: str) -> Column:
        stem = F.concat(*[syllable(SYLLABLES[script], k) for k in (1, 2, 3)])
        end = (F.when(gender == "male", syllable(ENDINGS[script, "male"], 5))
               .when(gender == "female", syllable(ENDINGS[script, "female"], 5))
               .otherwise(syllable(ENDINGS[script, "any"], 5)))
        return F.concat(stem, end)

    return _in_script(canon, word("cyrillic"), word("greek"), word("latin"))


def draw(todo: DataFrame, key: str) -> DataFrame:
    """``todo`` (kind, canon, gender, attempt) with the column ``surrogate``. The hash and
    what is spelled from it are worked out once per entity."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    df = computed(todo, "digest", _digest(key, kind, canon, attempt))
    digest = F.col("digest")
    hexes = "0123456789abcdef"
    df = computed(df, "drawn", F.struct(
        F.translate(digest, "abcdef", "123456").alias("number"),
        F.translate(digest, hexes, LATIN).alias("latin"),
        F.translate(digest, hexes, CYRILLIC).alias("cyrillic"),
        F.translate(digest, hexes, GREEK).alias("greek")))
    drawn = F.col("drawn")
    df = computed(df, "spelled", F.when(kind.isin("card", "iban", "phone", "national"),
                                        _spell(canon, drawn["number"], drawn)))
    numbers = F.col("spelled")
    grown = F.when(attempt >= GROW_AFTER, F.substring(_in_script(
        F.substring_index(canon, "@", 1), drawn["cyrillic"], drawn["greek"], drawn["latin"]),
        65, 4)).otherwise("")
    domain = F.regexp_extract(canon, r"@(.*)(\.[^.]+)$", 1)
    email = F.concat(_spell(F.substring_index(canon, "@", 1), drawn["number"], drawn), grown,
                     F.lit("@"), _spell(domain, drawn["number"], drawn, backward=True),
                     F.regexp_extract(canon, r"(\.[^.]+)$", 1))
    ip = F.concat_ws(".", *[(F.conv(F.substring(digest, 1 + 2 * k, 2), 16, 10).cast("int")
                             % 223 + 1).cast("string") for k in range(4)])
    # A number's first digit is its scheme or country; a valid check digit stays valid.
    number = F.concat(F.substring(canon, 1, 1), F.substring(numbers, 2, 1000))
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    card = F.when(_luhn_sum(canon, True) % 10 == 0, F.concat(
        body, F.pmod(10 - _luhn_sum(body, False) % 10, F.lit(10)).cast("string"))).otherwise(number)
    iban = F.concat(F.substring(canon, 1, 2), F.substring(numbers, 3, 1000))
    out = (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
           .when(kind == "iban", iban).when(kind == "phone", number)
           .when(kind == "national", numbers)
           .otherwise(F.concat(_name(canon, F.col("gender"), digest), grown)))
    return computed(df, "surrogate", out).drop("digest", "drawn", "spelled")


def assign(entities: DataFrame, key: str, max_rounds: int = 40) -> DataFrame:
    """(kind, canon, surrogate) for the distinct (kind, canon) of ``entities``, whose
    column gender (male, female or null) is optional.

    Per round one aggregate finds the surrogates that two entities share and one
    semi-join those that are entities; only the number of clashes reaches the
    driver.
    """
    # Drawing costs far more than its few bytes suggest, so the entities are dealt
    # over all tasks.
    parts = shuffle_partitions(entities.sparkSession)
    gender = F.col("gender") if "gender" in entities.columns else F.lit(None).cast("string")
    agreed = F.when(F.min(gender) == F.max(gender), F.min(gender)).otherwise("any")
    todo = durable(entities.groupBy("kind", "canon").agg(
        agreed.alias("gender"), F.lit(0).alias("attempt"))
                   .repartition(parts, "kind", "canon"))
    real = todo.select(F.col("kind").alias("k"), F.col("canon").alias("s"))
    drawn = durable(draw(todo, key))
    for _ in range(max_rounds):
        owner = drawn.groupBy(F.col("kind").alias("k"), F.col("surrogate").alias("s")).agg(
            F.min("canon").alias("owner"), F.count("*").alias("n")).where("n > 1")
        same = (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s"))
        shared = drawn.join(owner, same).where("canon <> owner").select("kind", "canon")
        taken = drawn.join(real, same, "left_semi").select("kind", "canon")
        clash = durable(shared.union(taken).distinct())
        if clash.limit(1).count() == 0:
            return drawn.select("kind", "canon", "surrogate")
        again = drawn.join(clash, ["kind", "canon"]).select(
            "kind", "canon", "gender", (F.col("attempt") + 1).alias("attempt"))
        kept = drawn.join(clash, ["kind", "canon"], "left_anti")
        drawn = durable(kept.unionByName(draw(again.repartition(parts, "kind", "canon"), key)))
    raise ValueError(f"surrogates still clash after {max_rounds} rounds")


def _render(kind: Column, shown: Column, surrogate: Column) -> Column:
    """The surrogate in the surface's punctuation and letter case."""
    empty = F.struct(F.lit(1).alias("i"), F.lit("").alias("out"))

    def fill(pattern: str):
        def add(a: Column, c: Column) -> Column:
            hit = c.rlike(pattern)
            return F.struct((a["i"] + F.when(hit, 1).otherwise(0)).alias("i"),
                            F.concat(a["out"], F.when(hit, F.substring(surrogate, a["i"], 1))
                                     .otherwise(c)).alias("out"))
        return F.aggregate(F.split(shown, ""), empty, add, lambda a: a["out"])

    cased = (F.when((shown == F.upper(shown)) & (shown != F.lower(shown)), F.upper(surrogate))
             .when(kind != "email", F.initcap(surrogate)).otherwise(surrogate))
    return (F.when(kind == "keep", shown).when(kind == "ip", surrogate)
            .when(kind.isin("phone", "card", "national"), fill(r"\d"))
            .when(kind == "iban", fill(r"[A-Z0-9]")).otherwise(cased))


def _mentions(text: Column, names: Column) -> Column:
    """``text`` with the capitalised words that ``names`` (canonical form -> surrogate)
    holds replaced, in the letter case of each."""
    def told(w: Column) -> Column:
        name = F.try_element_at(names, F.lower(w))
        return F.coalesce(F.when(w == F.upper(w), F.upper(name)).otherwise(F.initcap(name)), w)

    words = F.transform(F.regexp_extract_all(text, F.lit(MENTION), F.lit(0)), told)
    return F.array_join(F.zip_with(F.split(text, MENTION, -1), F.concat(words, F.array(F.lit(""))),
                                   lambda a, b: F.concat(a, b)), "")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                     counts: bool = False) -> DataFrame:
    """``docs`` with surrogates in the text; with ``counts``, also the numbers of
    entities by kind (n_email, n_ip, n_iban, n_national, n_card, n_phone, n_name)."""
    body = whole_text(text_col)
    found = durable(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(body).alias("key"),
        F.posexplode(F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).alias("pos", "surface"))
        .distinct().withColumn("kind", _kind(F.col("surface"))))
    part = found.select("id", "key", "pos", F.posexplode(
        _parts(F.col("surface"), F.col("kind"))).alias("j", "p")).select(
        "id", "key", "pos", "j", "p.*")
    given = assign(part.where("kind <> 'keep'").select("kind", "canon", "gender"), key)
    name = F.when(F.col("kind").isin("given", "surname"), F.struct("canon", "kind", "surrogate"))
    told = part.join(given, ["kind", "canon"], "left").select("id", "key", "pos", name.alias("name"), F.struct(
        "j", _render(F.col("kind"), F.col("shown"), F.col("surrogate")).alias("t")).alias("p"))
    whole = told.groupBy("id", "key", "pos").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("p")), lambda p: p["t"]), " ").alias("t"),
        F.collect_list("name").alias("names"))
    i, k, r, n, m = fresh(docs, "_pii_id", "_pii_key", "_pii_texts", "_pii_kinds", "_pii_names")
    texts = whole.groupBy(F.col("id").alias(i), F.col("key").alias(k)).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]).alias(r),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))).alias(m))
    # A word that is a given name and a surname counts as the given name.
    first = F.filter(m, lambda x, at: (at == 0) | (F.get(F.col(m), at - 1)["canon"] != x["canon"]))
    texts = texts.withColumn(m, F.when(F.size(m) > 0, F.map_from_entries(F.transform(
        first, lambda x: F.struct(x["canon"], x["surrogate"])))))
    same = F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(body) == F.col(k))
    out = docs.join(texts, same, "left")
    clean = F.when(F.col(r).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(
        F.split(body, ANY, -1), lambda p, x: F.concat(
            F.when(F.col(m).isNull(), p).otherwise(_mentions(p, F.col(m))),
            F.coalesce(F.get(F.col(r), x), F.lit("")))), ""))
    columns = [clean.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if not counts:
        return out.select(*columns)
    i2, k2 = fresh(out, "_count_id", "_count_key")
    number = found.groupBy(F.col("id").alias(i2), F.col("key").alias(k2)).agg(
        *[F.count_if(F.col("kind") == name).alias(f"{n}_{name}") for name in KINDS])
    out = out.join(number, F.col(id_col).eqNullSafe(F.col(i2))
                   & (F.xxhash64(body) == F.col(k2)), "left")
    return out.select(*columns, *[F.coalesce(f"{n}_{name}", F.lit(0)).alias(f"n_{name}")
                                  for name in KINDS])
