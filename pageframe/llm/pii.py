"""PII surrogates: entities give way to keyed stand-ins of their own type, one to one over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pageframe.llm.common import row_key, saved, without

# Patterns by kind, in order of precedence.  Titles tell a name's gender; scripts are Latin,
# Cyrillic and Greek.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Mlle", "Madame", "Sra", "Señora", "Doña", "Г-жа", "Госпожа", "Κυρία")
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "M", "Monsieur", "Sr", "Señor", "Don", "Г-н", "Господин", "Κύριος")
TITLES = ("Dr", "Doctor", "Prof", "Professor")   # either gender: that of the given name, if it is a known female one
_WORD = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![\dA-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\dA-Za-z])",
    "ipv6": r"(?<![\dA-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\dA-Za-z:])",
    "ip": r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d.]*\d)",
    "card": r"(?<![\dA-Za-z])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\dA-Za-z])",
    "phone": r"(?<![\dA-Za-z+])(?:\+?\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\dA-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(FEMALE_TITLES + MALE_TITLES + TITLES)})\.? {_WORD}(?: {_WORD}){{0,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# Given names by script and gender, syllables of family names by script.
GIVEN = {("latin", "f"): ("Anna", "Clara", "Emma", "Irene", "Julia", "Laura", "Maria", "Nora", "Sofia", "Vera"),
         ("latin", "m"): ("Adam", "Carl", "David", "Felix", "Hugo", "Leon", "Martin", "Oscar", "Paul", "Viktor"),
         ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София"),
         ("cyrillic", "m"): ("Антон", "Борис", "Иван", "Лев", "Максим", "Олег", "Павел", "Юрий"),
         ("greek", "f"): ("Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Νίκη", "Σοφία"),
         ("greek", "m"): ("Γιώργος", "Ιάσων", "Κώστας", "Νίκος", "Πέτρος", "Στέφανος")}
SYLLABLES = {"latin": ("ba", "den", "fo", "gar", "hel", "ker", "lin", "mo", "nor", "pe", "ra", "sten", "tal", "ver", "wi", "zan"),
             "cyrillic": ("ба", "вор", "гон", "дан", "жен", "зор", "ки", "лин", "мар", "нов", "пет", "рос", "сав", "тим", "фед", "чер"),
             "greek": ("αλ", "βαρ", "γεν", "δη", "θεο", "καρ", "λα", "μαν", "νικ", "παν", "ρα", "σιν", "τσα", "φιλ", "χρι", "στα")}
# Country calling codes: one digit, two digits, else three.
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
ROUNDS = 40


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern the whole entity fits."""
    chosen = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        chosen = F.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(chosen)
    return chosen


def canonical(kind: Column, entity: Column) -> Column:
    """What makes two mentions one entity: case of an address, punctuation of a number, title of a name don't count.

    A phone number is all its digits, a leading 1 before ten of them left out; a name is its words, see `word_entities`."""
    digits = F.regexp_replace(entity, r"\D", "")
    plain = F.regexp_replace(digits, r"^1(?=\d{10}$)", "")
    return (F.when(kind.isin("email", "ipv6"), F.lower(entity)).when(kind == "ip", entity).when(kind == "card", digits)
            .when(kind == "iban", F.replace(entity, F.lit(" "))).when(kind == "phone", plain)
            .otherwise(F.concat_ws(" ", _gender(entity), _script(entity), F.lower(_bare(entity)))))


def words_of(entity: Column) -> Column:
    """The words of a canonical name as entities of their own: (kind, entity) structs, given names by gender and script, the
    family name by script."""
    parts = F.split(entity, " ")
    script, words = parts[1], F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(1)))
    return F.transform(words, lambda w, i: F.when(
        i < F.size(words) - 1, F.struct(F.lit("given").alias("kind"), F.concat_ws(" ", parts[0], script, w).alias("entity")))
        .otherwise(F.struct(F.lit("family").alias("kind"), F.concat_ws(" ", F.lit("-"), script, w).alias("entity"))))


def _bare(entity: Column) -> Column:
    return F.regexp_replace(entity, r"^\S+ ", "")


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, r"^(\S+) ", 1)


def _gender(entity: Column) -> Column:
    title = F.regexp_replace(_title(entity), r"\.$", "")
    known = [n for (_, gender), names in GIVEN.items() if gender == "f" for n in names]
    return F.when(title.isin(*FEMALE_TITLES) | (title.isin(*TITLES) & F.split(_bare(entity), " ")[0].isin(*known)), "f").otherwise("m")


def _script(entity: Column) -> Column:
    bare = _bare(entity)
    return F.when(bare.rlike(r"\p{IsCyrillic}"), "cyrillic").when(bare.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _pick(values, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def stand_in(kind: Column, entity: Column, key: str, turn: Column) -> Column:
    """The candidate number `turn` for a canonical entity, from a keyed hash of both: same kind, same shape."""
    seed = F.sha2(F.concat_ws("\n", F.lit(key), kind, entity, turn.cast("string")), 512)
    decimals = F.translate(F.regexp_replace(seed, "[d-f]", ""), "abc", "147")

    def number(at, size=7):
        return F.conv(F.substring(seed, at, size), 16, 10).cast("long")

    def syllables(script, at=20, n=4):
        return F.initcap(F.concat(*[_pick(SYLLABLES[script], number(at + 8 * i)) for i in range(n)]))

    given, family = F.lit(""), F.lit("")
    for (script, gender), names in GIVEN.items():
        one, two = _pick(names, number(1)), _pick(names, number(9))
        double = F.when(turn < 4, one).when(turn < 12, F.concat_ws("-", one, two)).otherwise(F.concat_ws("-", one, syllables(script, n=2)))
        given = F.when(entity.startswith(f"{gender} {script} "), double).otherwise(given)
        family = F.when(entity.startswith(f"- {script} "), syllables(script)).otherwise(family)
    domain = F.concat(F.lower(F.concat(*[_pick(SYLLABLES["latin"], number(80 + 8 * i)) for i in range(3)])), F.lit(".example."),
                      F.when(F.substring(entity, -4, 4) == ".com", "com").when(F.substring(entity, -4, 4) == ".net", "net").otherwise("org"))
    email = F.concat(F.lower(syllables("latin")), F.lit("."), F.conv(F.substring(seed, 60, 9), 16, 36), F.lit("@"), domain)
    octet = [(F.pmod(number(1 + 8 * i), F.lit(254)) + 1).cast("string") for i in range(4)]
    groups = F.concat_ws(":", F.lit("2001"), F.lit("db8"), *[F.regexp_replace(F.substring(seed, 1 + 4 * i, 4), "^0{1,3}", "") for i in range(6)])
    length = F.length(entity)
    code = F.when(length > 10, F.regexp_extract(entity, f"^({CALLING_CODES})", 1)).otherwise("")
    phone = F.concat(code, F.substr(decimals, F.lit(1), length - F.length(code)))
    body = F.substr(decimals, F.lit(1), length - 1)
    chars = F.split(F.substr(entity, F.lit(5)), "")
    account = F.array_join(F.transform(F.filter(chars, lambda c: c != ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(decimals, i + 1, F.lit(1))).otherwise(F.char(65 + F.pmod(F.ascii(F.substr(seed, i + 40, F.lit(1))), F.lit(26))))), "")
    return (F.when(kind == "email", F.lower(email)).when(kind == "ip", F.concat_ws(".", *octet)).when(kind == "ipv6", groups)
            .when(kind == "card", F.concat(body, _luhn(body))).when(kind == "phone", phone)
            .when(kind == "iban", F.concat(F.substr(entity, F.lit(1), F.lit(2)), _mod97(account, F.substr(entity, F.lit(1), F.lit(2))), account))
            .when(kind == "given", given).otherwise(family))


def _luhn(body: Column) -> Column:
    """The check digit of a card number."""
    digits = F.transform(F.filter(F.split(F.reverse(body), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.pmod(10 - F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10)), F.lit(10)).cast("string")


def _mod97(account: Column, country: Column) -> Column:
    """The two check digits of an account in a country: 98 less its number modulo 97, letters read as 10 to 35."""
    chars = F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), F.pmod(a * 10 + F.ascii(c) - 48, F.lit(97)))
                       .otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): one to one, and no surrogate is itself an entity.

    Every entity proposes a stand-in by its keyed hash.  A proposal that an entity of the corpus bears, or
    that an earlier round gave away, or that another entity (first in text order) makes as well, is
    dropped and the next one tried, until all have one.  Proposals are compared as they are written, without case;
    family names with the family and given names of the corpus, given names with each other only, since a name
    differs by its family name already.  Each round groups by proposal, so a group is as large as a collision; rounds
    shrink by the collision rate.
    """
    todo, done = entities.select("kind", "entity"), None
    word = F.when(F.col("kind").isin("given", "family"), F.element_at(F.split("entity", " "), -1)).otherwise(F.col("entity"))
    taken = entities.select(F.when(F.col("kind") == "given", "family").otherwise(F.col("kind")).alias("kind"), F.lower(word).alias("_face"))
    taken = saved(taken.distinct(), "entity-words")
    for turn in range(ROUNDS):
        offers = todo.withColumn("surrogate", stand_in(F.col("kind"), F.col("entity"), key, F.lit(turn)))
        offers = offers.withColumn("_face", F.lower("surrogate"))
        gender = F.when(F.col("kind") == "given", F.substring("entity", 1, 1)).otherwise("")
        rank = F.row_number().over(Window.partitionBy("kind", gender, "_face").orderBy("entity"))
        fresh = offers.withColumn("_rank", rank).where("_rank = 1").drop("_rank").join(taken, ["kind", "_face"], "left_anti")
        if done is not None:
            fresh = fresh.join(done.select("kind", "_face", F.substring("entity", 1, 1).alias("_first")), (fresh["kind"] == done["kind"])
                               & (fresh["_face"] == done["_face"]) & ((fresh["kind"] != "given") | (F.substring(fresh["entity"], 1, 1) == F.col("_first"))), "left_anti")
        fresh = saved(fresh.select("kind", "entity", "surrogate", "_face"), "surrogates")
        done = fresh if done is None else done.unionByName(fresh)
        todo = saved(todo.join(fresh, ["kind", "entity"], "left_anti"), "without-surrogate")
        if not todo.limit(1).count():
            return done.drop("_face")
    raise ValueError(f"no free surrogates after {ROUNDS} rounds: a kind has more entities than its format has values")


def rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format: digit by digit, punctuation and a leading 1 kept; a name's title kept."""
    digits = F.regexp_replace(mention, r"[^0-9A-Za-z]", "")
    whole = F.when((kind == "phone") & (F.length(digits) == F.length(surrogate) + 1), F.concat(F.lit("1"), surrogate)).otherwise(surrogate)
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    filled = F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("used")), lambda s, c: F.when(
        c.rlike("[0-9A-Za-z]"), F.struct(F.concat(s["out"], F.substr(whole, s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used"))), lambda s: s["out"])
    return (F.when(kind.isin("card", "phone", "iban"), filled)
            .when(kind == "name", F.concat_ws(" ", _title(mention), surrogate)).otherwise(surrogate))


def name_table(names: DataFrame, words: DataFrame) -> DataFrame:
    """(kind, entity, surrogate) of whole names from the table of their words; family names stay together, so a family
    name alone and the same with a given name are recognisably one family."""
    each = names.select("entity", F.posexplode(words_of(F.col("entity"))).alias("at", "w")).select("entity", "at", "w.kind", F.col("w.entity").alias("word"))
    put = each.join(words.withColumnRenamed("entity", "word"), ["kind", "word"])
    whole = put.groupBy("entity").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))), lambda x: x["surrogate"]), " ").alias("surrogate"))
    return whole.select(F.lit("name").alias("kind"), "entity", "surrogate")


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """All columns of `docs`, the text with stand-ins for its entities, and entities: how many of each kind were replaced.

    Kinds: email, iban, ipv6, ip, card, phone, and names after a title.  Mentions of one entity get one surrogate in
    every document (case, punctuation and title of a mention don't count), different entities different
    ones as they are written, and no surrogate is an entity of the corpus.  Names go word by word: a family name keeps one
    stand-in wherever it stands, a given name one for its gender and script; where a document names someone in full
    after a title, the full name without a title is replaced there too.  Numbers keep length, punctuation and country
    code and get valid check digits, names gender and script, all by a hash keyed with `key`: the same key gives the
    same stand-ins for the same corpus.

    DataFrame functions only.  Texts move once, by a key of id and text; mentions meet the table of
    surrogates by entity, one row per document and mention.  A null or empty text is unchanged and has no
    entities; repeated rows get the same text; a column named entities is replaced.
    """
    base = without(docs, "entities", "_key")
    mentions = F.array_distinct(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    found = saved(base.select(row_key().alias("_key"), F.explode(mentions).alias("mention")).distinct()
                  .withColumn("kind", kind_of(F.col("mention"))).withColumn("entity", canonical(F.col("kind"), F.col("mention"))), "mentions")
    whole = saved(found.select("kind", "entity").distinct(), "entities")
    names = whole.where("kind = 'name'")
    parts = names.select(F.explode(words_of(F.col("entity"))).alias("w")).select("w.kind", "w.entity")
    given = saved(surrogate_table(saved(whole.where("kind <> 'name'").union(parts).distinct(), "entity-parts"), key), "surrogate-table")
    table = given.where("kind NOT IN ('given', 'family')").unionByName(name_table(names, given))
    named = (found.join(table, ["kind", "entity"])
             .select("_key", F.struct("mention", "kind", rendered(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("put")).alias("m"))
             .groupBy("_key").agg(F.collect_list("m").alias("_known")))
    joined = base.withColumn("_key", row_key()).join(named, "_key", "left")
    puts = F.map_from_entries(F.transform("_known", lambda m: F.struct(m["mention"], m["put"])))
    kinds = F.map_from_entries(F.transform("_known", lambda m: F.struct(m["mention"], m["kind"])))
    # The matches between the pieces of the split are those of the search: same pattern, same scan.
    pieces, hits = F.split("text", ENTITY, -1), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))
    filled = F.concat(F.array_join(F.zip_with("_pieces", "_hits", lambda p, h: F.concat(p, F.coalesce(F.element_at("_puts", h), F.lit("")))), ""))
    work = joined.withColumns({"_puts": puts, "_kinds": kinds, "_pieces": F.when(F.col("_known").isNotNull(), pieces),
                               "_hits": F.when(F.col("_known").isNotNull(), hits)})
    counted = F.transform(F.col("_hits"), lambda h: F.element_at("_kinds", h))
    entities = F.struct(*[F.coalesce(F.size(F.filter("_counted", lambda k: k == kind)).cast("long"), F.lit(0)).alias(kind) for kind in PATTERNS])
    # Full names without their title, where the document has them with one: letters, blanks and hyphens only, so no escapes.
    bare = F.array_distinct(F.transform(F.filter("_known", lambda m: (m["kind"] == "name") & _bare(m["mention"]).contains(" ")), lambda m: F.struct(
        _bare(m["mention"]).alias("old"), _bare(m["put"]).alias("new"))))
    named_too = F.aggregate(bare, filled, lambda text, n: F.regexp_replace(
        text, F.concat(F.lit(r"(?<!\p{L})"), n["old"], F.lit(r"(?!\p{L}|-\p{L})")), n["new"]))
    columns = [F.when(F.col("_known").isNull(), F.col("text")).otherwise(named_too).alias(c) if c.lower() == "text" else F.col(f"`{c}`")
               for c in base.columns]
    return work.withColumn("_counted", F.coalesce(counted, F.array().cast("array<string>"))).select(*columns, entities.alias("entities"))
