"""PII surrogates by DataFrame expressions only.

Detected entities (e-mail addresses, phone numbers, IPv4 addresses, payment cards with
a right check digit, US social security numbers, names of persons) get replacements
keyed by a secret: the same entity always gets the same one, in its own format; a given
name gets one of its gender and script, another name one of its script and ending.

A text is cut at its entities, each entity is replaced by an expression, and the parts
are joined again.  Two checks keep distinct entities apart over the whole corpus: no two
entities may share a surrogate, and no surrogate may be an entity that occurs.  The
entities that fail (usually a handful) are keyed again until none does; only these travel
back to their texts, all others need no join.

Phone numbers: 3-3-4 groups; a plus sign and 8 to 15 digits; 00 and a country code, or a
trunk 0 with 9 to 12 digits in all, in groups or not.  The country code and the trunk digit
stay, so a number's national and international spellings agree.  Not covered: plain digits
without plus or zero, and 13 or more plain digits after 00, which may be any number.  Numbers
that follow a phone number by a blank can be taken as part of it, up to its longest form.
E-mail addresses may hold Latin, Greek and Cyrillic letters.

Cases: a null text stays null, an empty one empty; a text without an entity is returned
unchanged to the character; a number that only looks like a card (wrong check digit) is
left alone; repeated rows give repeated results; columns other than ``text`` pass through
untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_or_shuffled, stored

# Given names by gender and script, and titles by gender.
GIVEN = {
    "latin_f": "Alice Anna Barbara Carla Clara Diana Elena Emma Eva Greta Helena Ingrid Julia Laura Lucia Maria Marta Nina Olivia Paula Sarah Sofia Teresa Victoria".split(),
    "latin_m": "Adam Albert Anton Bruno Carlos Daniel David Eric Felix Frank George Henry Hugo James John Karl Lucas Martin Oscar Paul Peter Robert Thomas William".split(),
    "cyrillic_f": "Анна Вера Дарья Елена Ирина Ксения Лариса Мария Надежда Ольга Светлана Татьяна".split(),
    "cyrillic_m": "Андрей Борис Виктор Дмитрий Иван Максим Михаил Николай Олег Павел Сергей Юрий".split(),
    "greek_f": "Αγγελική Αθηνά Δήμητρα Ειρήνη Ελένη Ζωή Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    "greek_m": "Αλέξανδρος Ανδρέας Γιώργος Δημήτρης Ηλίας Κώστας Μιχάλης Νίκος Πέτρος Σπύρος".split(),
}
TITLES_F = "Mrs Ms Miss Frau Madame Mme Señora Sra".split()
TITLES_M = "Mr Herr Monsieur Señor Sr".split()
TITLES = TITLES_F + TITLES_M + "Dr Prof".split()
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke la le li lo ma me mi mo na ne no pa re ri ro sa se si so ta te to va ve vi vo".split(),
    "cyrillic": "ба бе бо ва ве ви да де до за зе ка ке ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са се си со та те ти то ха хо".split(),
    "greek": "βα βε βο γα γε γο δα δε δο ζα ζε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε τι το φα φο".split(),
}

_WORD = r"\p{Lu}[\p{L}'’-]*\p{L}"
_TITLE = rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{'|'.join(TITLES)})\.?[ \t]"
_GIVEN = rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{'|'.join(n for names in GIVEN.values() for n in names)})[ \t]"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Letters of the scripts that part words by spaces, so that an address ends where its word does.
_LETTER = r"A-Za-z\p{IsLatin}\p{IsGreek}\p{IsCyrillic}\p{M}"
EMAIL = rf"(?<![0-9{_LETTER}._%+-])[0-9{_LETTER}._%+-]{{1,64}}@(?:[0-9{_LETTER}-]{{1,63}}\.){{1,8}}[{_LETTER}]{{2,24}}(?![0-9{_LETTER}-])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
PHONE = r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
#: International: a plus sign and 8 to 15 digits, in groups or not.
_GROUPED = r"[ \u00A0\u202F./()-]{0,2}[0-9]"
PHONE_PLUS = rf"(?<![\w+])\+[1-9](?:{_GROUPED}){{7,14}}(?![0-9])"
#: With the prefix 00, or national with the trunk digit 0 (9 to 12 digits); no date.
PHONE_ZERO = rf"(?<![\w+.,/-])(?:00[1-9](?:{_GROUPED}){{7,14}}|(?!0[1-9][ ./-][0-9]{{2}}[ ./-][12][0-9]{{3}}(?![0-9]))\(?0[1-9](?:{_GROUPED}){{7,10}})(?![\w]|[.,/-][0-9])"
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
CARD = r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-])"
NAME = rf"(?:{_TITLE}|{_GIVEN}){_WORD}(?:[ \t]{_WORD})?"
ENTITY = "|".join([EMAIL, IP, PHONE, PHONE_PLUS, SSN, CARD.replace("([ -])", "[ -]").replace(r"\1", "[ -]"), PHONE_ZERO, NAME])
#: Every entity holds a digit, an at sign, a title or a known given name.
HINT = rf"[0-9@]|{_TITLE}|{_GIVEN}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Sum with every second digit from the right doubled, the last digit counted once."""

    def total(d: Column) -> Column:
        def term(i: Column) -> Column:
            x = F.substr(d, i, F.lit(1)).cast("int")
            return F.when((F.length(d) - i) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + term(i))

    return _let(digits, total)


def kind(entity: Column) -> Column:
    """The type of a matched string; null for a number that is no card."""

    def number(d: Column) -> Column:
        out = F.when(entity.startswith("+") | (F.length(d) < 13), "phone").when(_luhn_sum(d) % 10 == 0, "card")
        return out.when(entity.rlike("^00[1-9][0-9]{0,2}[^0-9]"), "phone")

    return _let(
        entity,
        lambda e: F.when(F.contains(e, F.lit("@")), "email")
        .when(e.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"), "ip")
        .when(e.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(e.rlike(r"^\p{L}"), "name")
        .otherwise(_let(_digits(e), number)),
    )


def _name_kind(word: Column) -> Column:
    """given list, or surname by script; null for a title."""
    out = F.when(F.replace(word, F.lit("."), F.lit("")).isin(TITLES), F.lit(None).cast("string"))
    for which, names in GIVEN.items():
        out = out.when(word.isin(names), which)
    return out.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def units(entity: Column) -> Column:
    """array<struct<kind, value>>: the values of an entity that get surrogates; the words
    of a name are values of their own, so that a surname alone still means the same person."""
    words = F.filter(F.transform(F.split(entity, "[ \t]"), lambda w: F.struct(_name_kind(w).alias("kind"), F.lower(w).alias("value"))), lambda u: u["kind"].isNotNull())

    def one(k: Column) -> Column:
        return F.filter(F.array(F.struct(k.alias("kind"), _value(entity, k).alias("value"))), lambda u: u["kind"].isNotNull())

    return _let(kind(entity), lambda k: F.when(k == "name", words).otherwise(one(k)))


def _value(e: Column, k: Column) -> Column:
    """The normal form that all spellings of an entity share."""
    # a phone number without its country code and, where that can be one, its trunk digit
    phone = F.when(e.rlike(f"^{PHONE}$"), F.right(_digits(e), F.lit(10))).otherwise(F.regexp_replace(_digits(F.regexp_replace(e, rf"^(?:\+|00(?=[1-9])){_COUNTRY}", "")), "^0", ""))
    return F.when(k == "email", F.lower(e)).when(k == "ip", e).when(k == "phone", phone).otherwise(_digits(e))


def _hash(key: str, kind_: Column, value: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind_, value, attempt.cast("string")), 256)


def _number(h: Column, at: Column | int, n: int) -> Column:
    """A number from ``n`` hex digits of a hash, from place ``at`` on."""
    return F.conv(F.substr(h, F.lit(at) if isinstance(at, int) else at, F.lit(n)), 16, 10).cast("bigint")


def _digit_pool(h: Column) -> Column:
    """Thirty-two decimal digits of a hash."""
    return F.concat(*[F.lpad((_number(h, 1 + 14 * i, 14) % 10**8).cast("string"), 8, "0") for i in range(4)])


def _spelled(h: Column, value: Column) -> Column:
    """Each letter and digit of a lower-case value replaced by one of its class."""

    def char(i: Column) -> Column:
        c = F.substr(value, i, F.lit(1))
        n = _number(F.sha2(F.concat(h, i.cast("string")), 256), 1, 8)
        out = F.when(c.rlike("[a-z]"), F.char(97 + n % 26)).when(c.rlike("[0-9]"), F.char(48 + n % 10))
        for script, first, size in (("Cyrillic", 0x430, 32), ("Greek", 0x3B1, 17)):
            letters = F.lit("".join(map(chr, range(first, first + size))))
            out = out.when(c.rlike(rf"\p{{Is{script}}}"), F.substr(letters, (1 + n % size).cast("int"), F.lit(1)))
        return out.when(c.rlike(r"[\p{L}\p{M}]"), F.char(97 + n % 26)).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def _turned(key: str) -> dict[str, str]:
    """Every listed given name and its surrogate: the next one of its list in a keyed order, so
    that each name gets another one, no two the same, and one pair tells of no other."""
    out = {}
    for which, names in GIVEN.items():
        names = sorted(names, key=lambda n: hashlib.sha256(f"{key}\x1f{which}\x1f{n}".encode()).hexdigest())
        out |= {f"{which}\x1f{n.lower()}": names[(i + 1) % len(names)].lower() for i, n in enumerate(names)}
    return out


def surrogate(key: str, kind_: Column, value: Column, attempt: Column) -> Column:
    """The replacement of a value, in the same normal form as the value."""

    def letters(seed: Column, n: int) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.char(97 + _number(seed, 1 + 8 * i, 8) % 26)), "")

    def email(h: Column) -> Column:
        host = _let(F.sha2(F.concat_ws("\x1f", F.lit(key), F.substring_index(value, "@", -1), F.lit("host")), 256), lambda x: letters(x, 8))
        # a short address that keeps colliding grows by two letters
        longer = F.when(attempt > 3, letters(h, 2)).otherwise("")
        return F.concat(_spelled(h, F.substring_index(value, "@", 1)), longer, F.lit("@"), host, F.lit(".example.com"))

    def ip(h: Column) -> Column:
        return F.concat_ws(".", (1 + _number(h, 1, 8) % 223).cast("string"), *[(_number(h, 9 + 8 * i, 8) % 256).cast("string") for i in range(3)])

    def phone(h: Column) -> Column:
        whole = F.concat((2 + _number(h, 1, 2) % 8).cast("string"), F.substr(_digit_pool(h), F.lit(2), F.lit(2)), (2 + _number(h, 3, 2) % 8).cast("string"), F.substr(_digit_pool(h), F.lit(5), F.lit(6)))
        return F.left(F.concat(whole, F.substr(_digit_pool(h), F.lit(11), F.lit(22))), F.length(value))

    def card(h: Column) -> Column:
        body = F.concat(F.left(value, F.lit(1)), F.substr(_digit_pool(h), F.lit(1), F.length(value) - 2))
        return _let(body, lambda b: F.concat(b, ((10 - _luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))

    def surname(h: Column, parts: list[str]) -> Column:
        listed = F.split(F.lit(" ".join(parts)), " ")
        made = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.element_at(listed, (_number(h, 1 + 8 * i, 8) % len(parts) + 1).cast("int"))), "")
        last = F.right(value, F.lit(1))
        # the last letter stays: in many languages it shows the gender of a surname
        return F.concat(made, F.when(last.rlike(r"^\p{L}$"), last).otherwise(""))

    given = F.create_map(*[F.lit(x) for pair in _turned(key).items() for x in pair])

    def made(h: Column) -> Column:
        out = F.when(kind_ == "email", email(h)).when(kind_ == "ip", ip(h)).when(kind_ == "phone", phone(h)).when(kind_ == "card", card(h)).when(kind_ == "ssn", F.left(_digit_pool(h), F.lit(9)))
        for script, parts in SYLLABLES.items():
            out = out.when(kind_ == script, surname(h, parts))
        return out.otherwise(F.try_element_at(given, F.concat(kind_, F.lit("\x1f"), value)))

    return _let(_hash(key, kind_, value, attempt), made)


def _cased(word: Column, like: Column) -> Column:
    return _let(word, lambda w: F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(w)).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2), F.length(w)))))


def _poured(e: Column, digits: Column) -> Column:
    """The digits put in the places of the last digits of an entity; the rest stays."""
    before = F.length(_digits(e)) - F.length(digits)

    def char(i: Column) -> Column:
        c = F.substr(e, i, F.lit(1))
        nth = F.length(_digits(F.left(e, i))) - before
        return F.when(c.rlike("[0-9]") & (nth > 0), F.substr(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(e)), char), "")


def replacement(key: str, entity: Column, again: Column) -> Column:
    """The surrogate of an entity as it stands in a text; ``again``: map of kind and value
    to the number of the attempt, for values that are keyed again."""

    def made(k: Column, value: Column) -> Column:
        tries = F.coalesce(F.try_element_at(again, F.concat(k, F.lit("\x1f"), value)), F.lit(0))
        return _let(F.struct(k.alias("k"), value.alias("v"), tries.alias("t")), lambda u: surrogate(key, u["k"], u["v"], u["t"]))

    def part(u: Column) -> Column:
        """One word of a name, or a whole entity of another kind."""
        new = made(u["k"], F.when(u["name"], F.lower(u["e"])).otherwise(_value(u["e"], u["k"])))
        whole = _let(new, lambda n: F.when(u["name"], _cased(n, u["e"])).when(u["k"].isin("email", "ip"), n).otherwise(_poured(u["e"], n)))
        return F.when(u["k"].isNull(), u["e"]).otherwise(whole)

    def parts(k: Column) -> Column:
        words = F.transform(F.split(entity, "[ \t]"), lambda w: F.struct(w.alias("e"), _name_kind(w).alias("k"), F.lit(True).alias("name")))
        return F.when(k == "name", words).otherwise(F.array(F.struct(entity.alias("e"), k.alias("k"), F.lit(False).alias("name"))))

    return F.array_join(F.transform(_let(kind(entity), parts), part), " ")


def _entities(text: Column) -> Column:
    """The matched strings of a text, in order; empty without a hint of one."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def keyed_again(texts: DataFrame, key: str, rounds: int = 40) -> DataFrame | None:
    """(text_hash, again) of the texts with values that need another attempt, if any.

    ``texts``: (text_hash, entities).  Raises if ``rounds`` attempts do not part all.
    """
    found = texts.select("text_hash", F.explode(F.flatten(F.transform("entities", units))).alias("u")).select("text_hash", "u.kind", "u.value")
    values = stored(found.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), "values")
    own = values.select("kind", F.col("value").alias("made"), F.lit(True).alias("occurs"))
    for _ in range(rounds):
        tried = values.withColumn("made", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt")))
        nth = F.row_number().over(Window.partitionBy("kind", "made").orderBy("attempt", "value"))
        # names of a list are turned, so they meet others of the list by design
        listed = F.col("kind").isin(list(GIVEN))
        checked = tried.withColumn("nth", nth).join(own, ["kind", "made"], "left").withColumn("bad", (F.col("nth") > 1) | (F.col("occurs").isNotNull() & ~listed))
        values = stored(checked.select("kind", "value", F.when(F.col("bad"), F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), "bad"), "values")
        if values.filter("bad").isEmpty():
            break
        values = values.drop("bad")
    else:
        raise ValueError(f"surrogates still collide after {rounds} attempts")
    again = values.filter("attempt > 0").select("kind", "value", "attempt")
    if again.isEmpty():
        return None
    entry = F.struct(F.concat("kind", F.lit("\x1f"), "value").alias("k"), F.col("attempt").alias("v"))
    return stored(found.distinct().join(again, ["kind", "value"]).groupBy("text_hash").agg(F.map_from_entries(F.collect_list(entry)).alias("again")), "again")


def replace_pii(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with surrogates in their text; ``count`` names a column for the number
    of replaced entities.  The key must be kept secret, else surrogates can be tried out."""
    keep = [c for c in docs.columns if c != count]
    body = F.col(text).cast("string")
    texts = docs.select(body.alias("_t")).filter(F.col("_t").rlike(HINT)).select(F.xxhash64("_t").alias("text_hash"), _entities(F.col("_t")).alias("entities"))
    texts = stored(texts.filter(F.size("entities") > 0), "entities")
    again = keyed_again(texts, key)
    # the row goes along in one column, so that no name of its own meets those used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), body.alias("_body"))
    nothing = F.expr("map('', 0)")
    if again is None:
        rows = rows.withColumn("_again", nothing)
    else:
        again = again.select(F.col("text_hash").alias("_hash"), F.col("again").alias("_again"))
        rows = rows.withColumn("_hash", F.xxhash64("_body")).join(small_or_shuffled(again, again.count()), "_hash", "left").withColumn("_again", F.coalesce("_again", nothing))
    rows = rows.withColumn("_found", _entities(F.col("_body")))
    # the text between entities and the surrogates, in turn; a text without any is not touched
    parts = F.zip_with(F.split("_body", ENTITY), F.transform("_found", lambda e: replacement(key, e, F.col("_again"))), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    own = lambda c: F.col("_row")[c]
    new = F.when(F.size("_found") == 0, own(text)).otherwise(F.array_join(parts, ""))
    out = [(new if c == text else own(c)).alias(c) for c in keep]
    if count:
        out.append(F.when(F.col("_body").isNull(), 0).otherwise(F.size(F.filter("_found", lambda e: kind(e).isNotNull()))).alias(count))
    return rows.select(*out)
