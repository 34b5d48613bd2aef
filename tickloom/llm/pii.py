"""Replace personal data by keyed surrogates of the same kind and look.

Found are e-mail addresses, IPv4 addresses, phone, card and social security numbers, IBANs, cloud access keys,
assigned secrets (``password=...``, ``token = "..."``) and names that follow a title. Every distinct
entity has one surrogate, made from a secret key, so it is the same wherever the entity is mentioned and
in whatever format: numbers keep their separators and country code, cards their first digit and their
check digit if it was right, IBANs their country and a right check number, addresses their labels and
letter case, secrets their alphabet, names their script, letter case and the ending that the
title's gender asks for.

No surrogate is a real entity or another entity's surrogate: what collides is made anew with the next
number of attempt, the smallest entity first, until nothing collides.

Everything is a built-in expression. Texts are searched once; the surrogates are made in the table of
distinct entities; mentions are joined with them by value and go back to their text by its digest, in
an equi-join that adaptive execution splits on frequent texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

MALE = ("Mr", "Herr", "Sr", "Señor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Señora", "Госпожа", "Κυρία")
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Patterns by type, in order of precedence. None starts inside a word or number, so long ones cost no more.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
              r"(?=[A-Za-z+/_-]{0,200}[0-9])[A-Za-z0-9+/_-]{6,}[\"']?",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})\.? \p{{Lu}}[\p{{Ll}}\p{{M}}]+(?: \p{{Lu}}[\p{{Ll}}\p{{M}}]+)?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Letters by script: (pattern of its letters, pattern of its vowels, vowels, consonants, female and male ending).
SCRIPTS = (
    ("[а-яё]", "[аеёиоуыэюя]", "аеиоуя", "бвгдзклмнпрст", "а", "н"),
    ("[α-ωά-ώ]", "[αεηιουωάέήίόύώ]", "αεηιου", "βγδζκλμνπρτφ", "α", "ς"),
    (r"\p{L}", r"[^bcdfghjklmnpqrstvwxzßñç]", "aeiou", "bcdfghjklmnprstvz", "a", "n"),
)
LETTERS, HEX, DIGITS = "abcdefghijklmnopqrstuvwxyz", "abcdef", "0123456789"
MAX_ATTEMPTS = 64


def find(text: Column) -> Column:
    """All mentions in a text, in order."""
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def type_of(value: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _secret(value: Column, group: int) -> Column:
    return F.regexp_extract(value, r"^([A-Za-z_-]+\s*[=:]\s*[\"']?)([A-Za-z0-9+/_-]+)([\"']?)$", group)


def _words(value: Column) -> Column:
    """The words of a name after its title."""
    return F.slice(F.split(value, " "), 2, 2)


def entities(value: Column, kind: Column) -> Column:
    """The entities of a mention: an array of (type, canonical form); names have one for each word."""
    one = (
        F.when(kind == "email", F.lower(value)).when(kind.isin("ssn", "card"), _digits(value))
        .when(kind == "phone", F.right(_digits(value), F.lit(10))).when(kind == "secret", _secret(value, 2))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value)
    )
    female = value.rlike(rf"^(?:{'|'.join(FEMALE)})\b|^(?:Госпожа|Κυρία|Señora)[ .]")
    words = _words(value)
    given = F.when(female, "female").otherwise("male")
    named = F.transform(words, lambda w, i: F.struct(
        F.when((i == 0) & (F.size(words) == 2), given).otherwise("surname").alias("type"), F.lower(w).alias("entity")))
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("type"), one.alias("entity"))))


def _stream(key: str, kind: Column, entity: Column, attempt: int) -> Column:
    """Keyed hex digits, two for each character of the entity."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(entity) / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(
        F.concat_ws("\u001f", F.lit(key), kind, entity, F.lit(str(attempt)), b.cast("string")), 256)), "")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _luhn(digits: Column) -> Column:
    """The sum of a card number's digits, every second from the right doubled, modulo 10."""
    figures = F.reverse(F.split(digits, ""))
    each = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10


def _mod97(code: Column) -> Column:
    """An IBAN's remainder; letters count as 10 to 35."""
    step = lambda total, c: F.when(c.rlike("[0-9]"), (total * 10 + c.cast("int")) % 97).otherwise(
        (total * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(code, ""), F.lit(0), step)


def surrogate(kind: Column, entity: Column, stream: Column) -> Column:
    """The surrogate of an entity in its canonical form, from its keyed stream of hex digits."""
    def byte(i: Column) -> Column:
        return F.conv(F.substr(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")

    def same_kind(letters: Column, keep: Column) -> Column:
        def change(c: Column, i: Column) -> Column:
            n = byte(i)
            letter = F.when(letters == "hex", _pick(HEX, n)).otherwise(_pick(LETTERS, n))
            return F.when(keep(i), c).when(c.rlike("[0-9]"), _pick(DIGITS, n)).when(c.rlike("[a-z]"), letter).when(
                c.rlike("[A-Z]"), F.upper(letter)).otherwise(c)
        return F.array_join(F.transform(F.split(entity, ""), change), "")

    never = lambda i: F.lit(False)
    any_letter = F.lit("any")
    top = F.length(entity) - F.length(F.substring_index(entity, ".", -1))
    mail = same_kind(any_letter, lambda i: i >= top)
    secret = same_kind(F.when(entity.rlike("^[0-9a-f]+$"), "hex").otherwise("any"), never)
    ip = F.concat_ws(".", (byte(F.lit(0)) % 223 + 1).cast("string"), *[byte(F.lit(k)).cast("string") for k in (1, 2, 3)])
    card = same_kind(any_letter, lambda i: i == 0)
    body = F.substr(card, F.lit(1), F.length(card) - 1)
    checked = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    iban = same_kind(any_letter, lambda i: i < 2)
    account, country = F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(2))
    check = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")

    def name(script: tuple) -> Column:
        _, vowel, vowels, consonants, female, male = script
        made = F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(
            c.rlike(vowel), _pick(vowels, byte(i))).otherwise(_pick(consonants, byte(i)))), "")
        stem = F.when(F.length(made) > 2, F.substr(made, F.lit(1), F.length(made) - 1)).otherwise(made)
        return F.when(kind == "female", F.concat(stem, F.lit(female))).when(
            kind == "male", F.concat(stem, F.lit(male))).otherwise(made)

    person = F.when(entity.rlike(SCRIPTS[0][0]), name(SCRIPTS[0])).when(
        entity.rlike(SCRIPTS[1][0]), name(SCRIPTS[1])).otherwise(name(SCRIPTS[2]))
    return (
        F.when(kind == "email", mail).when(kind == "secret", secret).when(kind == "ip", ip)
        .when(kind == "key", same_kind(any_letter, lambda i: i < 4))
        .when(kind == "card", F.when(_luhn(entity) == 0, checked).otherwise(card))
        .when(kind == "iban", F.concat(country, check, account))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substr(same_kind(any_letter, never), F.lit(2))))
        .when(kind == "phone", same_kind(any_letter, never)).otherwise(person)
    )


def render(value: Column, kind: Column, made: Column) -> Column:
    """A mention with its entities' surrogates ``made`` (an array) in its own format."""
    one = F.element_at(made, 1)
    chars = F.split(value, "")

    def from_right(text: Column) -> Column:
        def change(c: Column, i: Column) -> Column:
            after = F.length(_digits(F.substr(text, i + 2)))  # digits to the right
            return F.when(c.rlike("[0-9]") & (after < F.length(one)), F.substr(one, F.length(one) - after, F.lit(1))).otherwise(c)
        return F.array_join(F.transform(chars, change), "")

    def with_case(text: Column) -> Column:
        return F.array_join(F.transform(chars, lambda c, i: F.when(
            c.rlike("[A-Z]"), F.upper(F.substr(one, i + 1, F.lit(1)))).otherwise(F.substr(one, i + 1, F.lit(1)))), "")

    spaces = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", " ").otherwise(
        F.substr(one, i + 1 - (i - F.length(F.replace(F.substr(value, F.lit(1), i), F.lit(" "), F.lit("")))), F.lit(1)))), "")
    title = F.substring_index(value, " ", 1)
    return (
        F.when(kind == "email", with_case(value)).when(kind.isin("phone", "card", "ssn"), from_right(value))
        .when(kind == "secret", F.concat(_secret(value, 1), one, _secret(value, 3)))
        .when(kind == "iban", spaces)
        .when(kind == "name", F.concat_ws(" ", title, F.array_join(F.transform(made, lambda w: F.initcap(w)), " ")))
        .otherwise(one)
    )


def assign(known: DataFrame, key: str) -> DataFrame:
    """(type, entity, surrogate) of distinct (type, entity) rows, without collisions.

    Raises if an entity has found no free surrogate in ``MAX_ATTEMPTS`` rounds.
    """
    known = common.written(known.select("type", "entity").distinct())
    settled, pending = None, known
    for attempt in range(MAX_ATTEMPTS):
        made = pending.withColumn("stream", _stream(key, F.col("type"), F.col("entity"), attempt))
        made = made.withColumn("surrogate", surrogate(F.col("type"), F.col("entity"), F.col("stream"))).drop("stream")
        real = known.select("type", F.col("entity").alias("surrogate"))
        taken = real if settled is None else real.union(settled.select("type", "surrogate"))
        free = made.join(taken, ["type", "surrogate"], "left_anti")
        won = common.written(free.groupBy("type", "surrogate").agg(F.min("entity").alias("entity")).select("type", "entity", "surrogate"))
        settled = won if settled is None else settled.union(won)
        rest = common.written(pending.join(won, ["type", "entity"], "left_anti"))
        if rest.isEmpty():
            return settled
        pending = rest
    raise ValueError("some entities have no free surrogate")


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, with surrogates in ``text_col``.

    Null and empty texts and those without personal data stay as they are. Equal texts get equal results.
    Mentions that differ only in format (letter case of an address, separators of a number) are one entity.
    """
    digest, values, made = common.fresh(docs, "digest", "mentions", "surrogates")
    empty = F.coalesce(F.length(F.col(text_col)) == 0, F.lit(True))
    mark = F.when(empty, F.concat(F.lit("-"), F.xxhash64(id_col).cast("string"))).otherwise(F.sha2(text_col, 256))
    found = docs.select(mark.alias(digest), find(F.col(text_col)).alias(values)).where(F.size(values) > 0)
    found = common.written(found.groupBy(digest).agg(F.any_value(values).alias(values)))

    mentions = found.select(digest, F.posexplode(values).alias("place", "value"))
    distinct = mentions.select("value").distinct().withColumn("kind", type_of(F.col("value")))
    parts = common.written(distinct.select("value", "kind", F.posexplode(entities(F.col("value"), F.col("kind"))).alias("part", "e"))
                           .select("value", "kind", "part", "e.type", "e.entity"))
    named = parts.join(assign(parts, key), ["type", "entity"]).groupBy("value", "kind").agg(
        F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("parts"))  # two at most
    shown = common.written(named.select("value", render(F.col("value"), F.col("kind"), F.col("parts.surrogate")).alias("shown")))
    # Written, so that the last join has a plain shuffle on either side, which is split on a frequent text.
    ready = common.written(mentions.join(shown, "value").groupBy(digest).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "shown"))), lambda m: m["shown"]).alias(made)))

    pieces = F.split(F.col(text_col), ENTITY, -1)
    woven = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col(made), i), F.lit("")))), "")
    marked = docs.withColumn(digest, mark).join(ready, digest, "left")
    text = F.when(F.col(made).isNull(), F.col(text_col)).otherwise(woven)
    return marked.withColumn(text_col, text).select(*docs.columns)
