"""Personal data replaced by surrogates of the same kind and format, the same one wherever an entity is mentioned.

A surrogate is a keyed hash of the entity, shaped like it; what is shaped is the entity without its format, so that two
ways of writing a number stay the same number.  Surrogates of different entities may still meet, or meet a real
one: all distinct entities are checked, and those that collide are hashed again until none does.  Only the few
that took another attempt are joined to the documents; everything else is worked out where the text lies.

DataFrame functions only; texts never pass through Python.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.llm.columns import let
from opsframe.llm.line_dedup import text_hash
from opsframe.storage import cut_lineage

# Titles before names, by what they say of the person.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "госпожа"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "господин"],
    "n": ["Dr", "Prof"],
}
# Syllables that made-up names consist of, and the ends that tell gender.
_LATIN = ["ba", "be", "bi", "da", "de", "do", "fa", "fi", "ga", "ka", "ke", "la", "le", "li", "lo", "ma", "me", "mi",
          "na", "ne", "no", "ra", "re", "ri", "ro", "sa", "se", "so", "ta", "te", "to", "va"]
_CYRILLIC = ["ба", "бе", "ва", "ве", "га", "да", "де", "ди", "за", "ка", "ко", "ла", "ле", "ли", "ма", "ме", "ми", "на",
             "не", "ни", "ра", "ре", "ри", "ро", "са", "се", "та", "те", "ти", "то", "ха", "ша"]
_ENDS = {"given f": ("lia", "лия"), "given m": ("don", "дон"), "given n": ("lin", "лин"), "family": ("ster", "нов")}

_TITLE = "|".join(t for kind in TITLES.values() for t in kind)
_NAME = r"\p{Lu}[\p{L}'’-]*+"
_ADDRESS_6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]*+\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}"
_NUMBERS = [
    r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,5}){2,4}(?!\w)",
    r"(?<![\w+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)",
    r"(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    r"(?<![\w.-])0[1-9]\d{1,3}[ /-]\d{5,8}(?![\w-])",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    r"(?<![\w-])(?:\d{4}[ -]){3}\d{1,7}(?!\w)",
    r"(?<!\w)\d{13,19}+(?!\w)",
]
_HEXADECIMAL = [r"(?<!\w)[0-9A-Fa-f]{32,}+(?!\w)", rf"(?<![\w:.])(?:{_ADDRESS_6})(?![\w:])"]
#: Behind a look at the next character, so that few places are tried against all of a group.
_PATTERNS = [
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    rf"(?=[\d+(])(?:{'|'.join(_NUMBERS)})",
    rf"(?=[0-9A-Fa-f]{{1,4}}:|[0-9A-Fa-f]{{32}})(?:{'|'.join(_HEXADECIMAL)})",
    r"(?=[A-Z]{2}\d)(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    rf"(?=\p{{Lu}}|[{''.join(sorted({t[0] for kind in TITLES.values() for t in kind if t[0].islower()}))}])(?<!\w)(?:{_TITLE})\.?\h+{_NAME}(?:\h+{_NAME}){{0,2}}",
]
#: One match for each entity; for \w and \b Unicode counts.
ENTITY = "(?U)" + "|".join(f"(?:{p})" for p in _PATTERNS)

#: What every entity has; a cheap look that spares most texts the patterns above.
_SIGN = "[0-9@]|[A-Fa-f]{32}|" + "|".join(rf"{t}[.\h]" for t in sorted(t for kind in TITLES.values() for t in kind))

# Ends of Cyrillic family names that women's forms change, as those forms and what men's have instead.
_WOMENS = r"(?<=..[оеё]в|..[иы]н)а$|(?<=..[сц]к)ая$"
_WOMENS_ADJECTIVE = "ая$"

#: After so many attempts a surrogate grows by a character: mail addresses and names, and numbers.
GROW_AFTER, GROW_NUMBERS_AFTER = 8, 32
#: Only IPv4 addresses, which cannot grow, could need as many.
MAX_ROUNDS = 1000
_ENTITY_TYPE = "array<struct<kind:string,norm:string>>"


def matches(text: Column) -> Column:
    """All that is to be replaced in a text."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(text.rlike(_SIGN), found).otherwise(F.array().cast("array<string>"))


def _kind(match: Column) -> Column:
    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "address")
        .when(match.contains(":"), "address 6")
        .when(match.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$|^0\d{2,4}[ /-]\d{5,8}$"), "phone")
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "person number")
        .when(match.rlike(r"^[0-9 -]+$") & (F.length(F.regexp_replace(match, r"\D", "")) <= 26), "card")
        .when(match.rlike(r"^[0-9A-Fa-f]{32,}$"), "secret")
        .when(match.rlike(r"^[A-Z]{2}\d{2}"), "account")
        .otherwise("name")
    )


def _plain(text: Column) -> Column:
    """Letters and digits alone, in lower case."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def _email_end(match: Column) -> Column:
    return F.concat(F.lit("."), F.substring_index(match, ".", -1))


def _norm(kind: Column, match: Column) -> Column:
    """What makes two mentions the same entity."""
    as_is = F.when(kind == "address", match).when(kind.isin("email", "address 6"), F.lower(match))
    return as_is.otherwise(_plain(match))


def _family(norm: Column) -> Column:
    """A family name as men have it, so that a woman's name and her brother's are one."""
    mens = F.when(norm.rlike(_WOMENS_ADJECTIVE), F.regexp_replace(norm, _WOMENS, "ий"))
    return F.when(norm.rlike(_WOMENS), mens.otherwise(F.regexp_replace(norm, _WOMENS, ""))).otherwise(norm)


def _name_tokens(match: Column) -> Column:
    """``kind, norm, text, womens`` of the parts of a name behind its title; ``womens``: the family name's form."""
    title = F.regexp_extract(match, rf"^({_TITLE})", 1)
    gender = F.when(title.isin(TITLES["f"]), "f").when(title.isin(TITLES["m"]), "m").otherwise("n")
    parts = F.slice(F.split(match, r"\h+"), F.lit(2), F.lit(9))
    given = F.concat(F.lit("given "), gender)

    def token(part: Column, i: Column) -> Column:
        family, norm = i == F.size(parts) - 1, _plain(part)
        womens = family & ((gender == "f") | ((gender == "n") & norm.rlike(_WOMENS)))
        return F.struct(
            F.when(family, "family").otherwise(given).alias("kind"),
            F.when(family, _family(norm)).otherwise(norm).alias("norm"),
            part.alias("text"),
            womens.alias("womens"),
        )

    return F.transform(parts, token)


def entities(match: Column) -> Column:
    """``kind, norm`` of every entity in a match: the parts of a name, or the match itself."""
    names = F.transform(_name_tokens(match), lambda t: F.struct(t["kind"].alias("kind"), t["norm"].alias("norm")))

    def of(kind: Column) -> Column:
        whole = F.array(F.struct(kind.alias("kind"), _norm(kind, match).alias("norm")))
        return F.when(kind == "name", names).otherwise(whole).cast(_ENTITY_TYPE)

    return let(_kind(match), of)


def _hash(key: Column, kind: Column, norm: Column, attempt: Column) -> Column:
    """64 hexadecimal digits that only the key's holder can work out: two nested hashes with the key."""
    inner = F.sha2(F.concat_ws("\x1f", key, kind, norm, attempt.cast("string")), 256)
    return F.sha2(F.concat(key, inner), 256)


def _number(hashed: Column, at: Column, most: int | Column) -> Column:
    """A number below ``most`` from two of the hash's digits, over and over."""
    digits = F.substring(hashed, (at * 2) % 62 + 1, F.lit(4))
    return (F.conv(digits, 16, 10).cast("int") + F.floor(at / 31).cast("int") * 7) % most


def _one_of(values: list[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), number)


def _character(kind: Column, old: Column, hashed: Column, at: Column) -> Column:
    hexadecimal = (kind == "secret") | ((kind == "address 6") & (old != ":"))
    characters = F.when(hexadecimal, "0123456789abcdef").when(old.rlike("[0-9]"), "0123456789")
    characters = characters.when(old.rlike(r"\p{L}"), "abcdefghijklmnopqrstuvwxyz").otherwise(old)
    return let(characters, lambda from_: F.substring(from_, _number(hashed, at, F.length(from_)) + 1, F.lit(1)))


def _luhn_rest(digits: Column, skip_last: bool) -> Column:
    """The Luhn sum modulo ten of a string of digits."""
    places = F.reverse(F.split(digits, ""))
    doubled = F.transform(
        places, lambda d, i: F.when(i % 2 == 1, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int"))
    )
    counted = F.slice(doubled, F.lit(2), F.size(doubled)) if skip_last else doubled
    return F.aggregate(counted, F.lit(0), lambda a, x: a + x) % 10


def surrogate(key: Column, kind: Column, norm: Column, attempt: Column) -> Column:
    """The surrogate of a normalised entity, itself normalised."""

    def made(hashed: Column) -> Column:
        def spelled(text: Column) -> Column:
            return F.array_join(F.transform(F.split(text, ""), lambda c, i: _character(kind, c, hashed, i)), "")

        def with_check(number: Column) -> Column:
            check = (10 - _luhn_rest(number, True)) % 10
            valid = F.concat(F.substring(number, F.lit(1), F.length(number) - 1), check.cast("string"))
            return F.when(_luhn_rest(norm, False) == 0, valid).otherwise(number)

        def more(after: int, with_: str) -> Column:
            return F.repeat(F.lit(with_), F.floor(attempt / after).cast("int"))

        end = _email_end(norm)
        email = F.concat(more(GROW_AFTER, "a"), F.substring(norm, F.lit(1), F.length(norm) - F.length(end)))
        email = F.concat(spelled(email), end)
        address = F.array_join(
            F.transform(F.split(norm, r"\."), lambda _, i: (_number(hashed, i, 254) + 1).cast("string")), "."
        )
        cyrillic = norm.rlike(r"\p{IsCyrillic}")
        last = F.least(F.greatest(F.length(norm) - 5, F.lit(1)), F.lit(4)) + F.floor(attempt / GROW_AFTER).cast("int")
        syllables = F.when(cyrillic, F.array(*map(F.lit, _CYRILLIC))).otherwise(F.array(*map(F.lit, _LATIN)))
        stem = F.transform(F.sequence(F.lit(0), last), lambda i: F.get(syllables, _number(hashed, i, len(_LATIN))))
        ends = [F.when(kind == k, F.when(cyrillic, e[1]).otherwise(e[0])) for k, e in _ENDS.items()]
        name = F.concat(F.array_join(stem, ""), F.coalesce(*ends))
        chosen = F.when(kind == "email", email).when(kind == "address", address).when(kind.isin(*_ENDS), name)
        longer = F.concat(norm, more(GROW_NUMBERS_AFTER, "0"))
        chosen = chosen.when((kind == "card") & norm.rlike("^[0-9]+$"), let(spelled(longer), with_check))
        # A short address with :: has room for more groups; one of eight groups has not, nor does it need any.
        chosen = chosen.when(kind == "address 6", spelled(F.when(norm.contains("::"), F.concat(norm, more(GROW_NUMBERS_AFTER, ":0000"))).otherwise(norm)))
        return chosen.otherwise(spelled(longer))

    return let(_hash(key, kind, norm, attempt), made)


def _shaped(old: Column, new: Column) -> Column:
    """``new`` in the format and case of ``old``: its characters stand where the letters and digits of ``old`` do.

    What ``new`` has more comes last.
    """
    step = lambda acc, c: F.when(
        c.rlike(r"[\p{L}\p{N}]"),
        F.struct(
            F.concat(acc["out"], F.when(c.rlike(r"\p{Lu}"), F.upper(F.substring(new, acc["at"], F.lit(1)))).otherwise(F.substring(new, acc["at"], F.lit(1)))).alias("out"),
            (acc["at"] + 1).alias("at"),
        ),
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at")))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    rest = lambda acc: F.substring(new, acc["at"], F.length(new))
    return F.aggregate(F.split(old, ""), start, step, lambda acc: F.concat(acc["out"], rest(acc)))


def replacement(key: Column, match: Column, attempts: Column) -> Column:
    """A match with its entities replaced; ``attempts`` maps the entities that needed more than one."""

    def made(entity: Column) -> Column:
        kind, norm = entity["kind"], entity["norm"]
        attempt = F.coalesce(F.try_element_at(attempts, F.concat_ws("\x1f", kind, norm)), F.lit(0))
        return let(attempt, lambda nth: surrogate(key, kind, norm, nth))

    def named(token: Column) -> Column:
        upper = token["text"].rlike(r"^\p{Lu}\p{Lu}+$")
        # All Cyrillic family names made here end alike, so women's forms do too.
        end = F.when(token["womens"] & token["norm"].rlike(r"\p{IsCyrillic}"), "а").otherwise("")
        return let(F.concat(made(token), end), lambda new: F.when(upper, F.upper(new)).otherwise(F.initcap(new)))

    title = F.regexp_extract(match, rf"^((?:{_TITLE})\.?\h+)", 1)
    name = F.concat(title, F.array_join(F.transform(_name_tokens(match), named), " "))

    def replaced(entity: Column) -> Column:
        as_is = entity["kind"].isin("email", "address")
        # The digits of a secret may be letters in its surrogate, so it has the case of the whole.
        lower, upper = (entity["kind"].isin("secret", "address 6") & ~match.rlike(other) for other in ("[A-F]", "[a-f]"))
        of_kind = lambda new: F.when(as_is | lower, new).when(upper, F.upper(new)).when(entity["kind"] == "address 6", new)
        return let(made(entity), lambda new: of_kind(new).otherwise(_shaped(match, new)))

    def of(kind: Column) -> Column:
        entity = F.struct(kind.alias("kind"), _norm(kind, match).alias("norm"))
        return F.when(kind == "name", name).otherwise(let(entity, replaced))

    return let(_kind(match), of)


def resolved(found: DataFrame, key: Column) -> DataFrame:
    """``kind, norm, attempt`` of the entities whose first surrogate met another's or a real entity.

    ``found`` has the distinct entities.  Of those that meet, the smallest keeps its surrogate; the others try again.
    """
    state = cut_lineage(found.select("kind", "norm", F.lit(0).alias("attempt")), "entities")
    real = state.select("kind", F.col("norm").alias("made"), F.lit(True).alias("is_real"))
    for _ in range(MAX_ROUNDS):
        made = state.withColumn("made", surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt")))
        same = Window.partitionBy("kind", "made").orderBy("attempt", "norm")
        # What a real entity is called is no surrogate, whoever it is.
        ranked = made.withColumn("nth", F.row_number().over(same)).join(real, ["kind", "made"], "left")
        clash = (F.col("nth") > 1) | F.col("is_real").isNotNull()
        state = cut_lineage(ranked.select("kind", "norm", F.when(clash, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), clash.alias("clash")), "attempts")
        if state.filter("clash").isEmpty():
            return state.filter("attempt > 0").select("kind", "norm", "attempt")
        state = state.drop("clash")
    raise RuntimeError(f"entities still collide after {MAX_ROUNDS} attempts")


def replace_entities(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text, and ``n_entities``; all its columns and rows stay.

    Entities are mail and network addresses, phone, card, account and person numbers, long hexadecimal secrets, and
    names behind a title.  The same entity has the same surrogate in every document; different ones have different
    ones, none of which is an entity that occurs.  Where a format has too few, as short mail addresses have,
    surrogates grow.  A Cyrillic family name in a woman's form is that in the man's form, and keeps its form.  Network
    addresses are the same if they are written the same but for case.

    Null and empty texts stay and have no entities.  Rows that repeat are treated alike; an empty table gives no row;
    texts of any length are replaced whole.  If ``docs`` has a column ``n_entities``, the new one is ``n_entities_2``, and
    so on.  ``key`` decides which surrogates are made and must be kept secret.
    """
    secret = F.lit(key)
    taken = {c.lower() for c in docs.columns}
    names = (f"n_entities_{n}" if n > 1 else "n_entities" for n in itertools.count(1))
    counted = next(name for name in names if name not in taken)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    each = rows.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.explode(matches(F.col("text"))).alias("match"))
    each = each.select("doc_id", "text_hash", F.explode(entities(F.col("match"))).alias("e"))
    mentioned = cut_lineage(each.select("doc_id", "text_hash", "e.kind", "e.norm").distinct(), "mentions")
    again = cut_lineage(resolved(mentioned.select("kind", "norm").distinct(), secret), "collisions")
    fixes = mentioned.join(again, ["kind", "norm"]).groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "norm"), "attempt"))).alias("_attempts")
    )
    fixes = cut_lineage(fixes.select(F.col("doc_id").alias("_of_doc"), F.col("text_hash").alias("_of_text"), "_attempts"), "fixes")

    whole = docs.select(F.struct("*").alias("_row"))
    body = F.col(f"_row.`{text}`")
    same = F.col(f"_row.`{doc_id}`").eqNullSafe(F.col("_of_doc")) & (text_hash(body) == F.col("_of_text"))
    joined = whole.join(fixes, same, "left").withColumn("_found", matches(body))
    new = F.transform("_found", lambda m: replacement(secret, m, F.col("_attempts")))
    pieces = F.zip_with(F.split(body, ENTITY, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    replaced = F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(body)
    return joined.select(
        *(replaced.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns),
        F.coalesce(F.size("_found"), F.lit(0)).cast("long").alias(counted),
    )
