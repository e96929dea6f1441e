"""Surrogates: formats, coreference, distinctness where they would collide, whole tables."""

import hashlib
import re

import regex
from conftest import SMALL
from pyspark.sql import functions as F

from opsframe.llm import surrogates as s

ROWS = [
    (1, "Mail a.b@Mail7.example.com or A.B@mail7.example.com, +1 (017) 555-7713; 97.51.17.173 and 4111 1111 1111 1111."),
    (2, "4111111111111111 is that card, 4111-1111-1111-1112 none; call (017) 555-7713 or 1 (017) 555-7713"),
    (3, "Mrs Anna Smith met Mr. Smith, Herr Karl Smith and Dr. SMITH; Госпожа Анна Петрова"),
    (4, 'token "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" 123-45-6789 DE89370400440532013000'),
    (5, None),
    (6, ""),
    (7, "No data here. Version 2.0, 1.2.3, 12345"),
    (None, "nameless a.b@mail7.example.com"),
]


def replaced(spark, rows, key="k"):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kind int, norm string")
    out = s.replace_entities(frame, key)
    assert out.columns == ["doc_id", "text", "kind", "norm", "n_entities"]
    assert s.replace_entities(frame.withColumnRenamed("kind", "N_ENTITIES"), key).columns[-1] == "n_entities_2"
    return out.collect()


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def test_formats_and_coreference(spark):
    got = {r.doc_id: r for r in replaced(spark, [*ROWS, ROWS[6], ROWS[0]])}
    one, two, three, four = (got[i].text for i in (1, 2, 3, 4))
    for i, text in ROWS:
        for secret in re.findall(r"\S+@\S+\w|\d[\d -]{14,}\d|[0-9a-f]{40}|Smith|SMITH|Петрова|555-7713", text or ""):
            assert secret not in got[i].text
    mails = re.findall(r"\S+@[\w.]+\w", one + got[None].text)
    assert len(mails) == 3 and len(set(mails)) == 1 and re.fullmatch(r"[a-z]\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com", mails[0])
    spaced, whole = re.search(r"(?:\d{4} ){3}\d{4}", one)[0], re.match(r"\d{16}", two)[0]
    assert spaced.replace(" ", "") == whole and luhn(whole) == 0
    assert all(0 < int(x) < 255 for x in re.search(r"\d+\.\d+\.\d+\.\d+", one)[0].split("."))
    family = re.search(r"Mr\. (\w+),", three)[1]
    assert three.count(family) == 3 and f"Dr. {family.upper()};" in three
    given = re.search(r"Mrs (\w+) ", three)[1], re.search(r"Herr (\w+) ", three)[1], re.search(r"Госпожа (\w+) ", three)[1]
    assert given[0].endswith("lia") and given[1].endswith("don") and re.fullmatch("[А-Я][а-я]+лия", given[2])
    assert re.fullmatch(r'token "[0-9a-f]{40}" \d{3}-\d{2}-\d{4} [A-Z]{2}\d{20}', four)
    assert got[5].text is None and got[6].text == "" and got[7].text == ROWS[6][1] and got[7].n_entities == 0
    again = {r.doc_id: r.text for r in replaced(spark, ROWS)}
    assert all(again[i] == got[i].text for i in again)
    assert {r.doc_id: r.text for r in replaced(spark, ROWS, "other")}[1] != one


def test_collisions_are_resolved(spark):
    # More names of one shape than an attempt has surrogates for, so that many must try again.
    names = [f"Mr {a}{b}o" for a in ["Ba", "Be", "Da", "Li", "Lo", "Ma", "Na", "Ro", "Sa", "Ta"] for b in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(i, f"{n} and {n}") for i, n in enumerate(names)]
    found = spark.createDataFrame([("family", n.split()[1].lower()) for n in names], "kind string, norm string")
    again = s.resolved(found, F.lit("k")).collect()
    assert len(again) > 10
    made = [re.fullmatch(r"Mr (\w+) and Mr (\w+)", r.text).groups() for r in replaced(spark, rows)]
    assert all(a == b for a, b in made) and len({a for a, _ in made}) == len(names)
    assert not {a for a, _ in made} & {n.split()[1] for n in names}


def test_no_rows(spark):
    assert s.replace_entities(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, "a@b.cc")], "doc_id long, text string")
    assert not re.search("Python|Pandas|Arrow", s.replace_entities(frame, "k")._jdf.queryExecution().executedPlan().toString())


def test_secrets_of_either_case_and_any_length(spark):
    digits = "9233A8EC5D0B41F7A6E2C39847D1F05B6A89329B"
    secrets = [digits, digits.lower(), digits[:20] + digits[20:].lower(), "AB12" * 50, "ABCDEF" * 6, "DE12" + "89AB" * 7]
    rows = [(i, f'TOKEN = "{s}"') for i, s in enumerate([*secrets, "1F" * 15 + "0"])]
    got = {r.doc_id: r for r in replaced(spark, rows)}
    new = [re.fullmatch('TOKEN = "([0-9A-Fa-f]+)"', got[i].text)[1] for i in range(len(secrets))]
    for old, made in zip(secrets, new):
        assert old.lower() != made.lower() and len(old) == len(made)
    assert new[0] == new[0].upper() and new[1] == new[1].lower()
    assert len({x.lower() for x in new[:3]}) == 1 and len({x.lower() for x in new}) == 4
    assert got[len(secrets)].n_entities == 0


MORE = [
    (10, "Call 555-123-4567 or (555) 123-4567 or 030 1234567; not 555-1234 nor 2024-01-02-555-123-4567."),
    (11, "From 2001:db8::1 and 2001:DB8::1, FE80:0:0:0:0:0:0:1 or fe80:0:0:0:0:0:0:1; not 12:30:45, a::b, std::c1."),
    (12, "Госпожа Анна Петрова и Господин Иван Петров, Dr. Петрова, Prof. Достоевская, Господин Достоевский, Dr Лист"),
    (13, "Sr José Álvarez, Mr O'Neil-Smith III; Ms Anna ANNA"),
]


def plain_surrogate(key, kind, norm, attempt):
    h = hashlib.sha256("\x1f".join([key, kind, norm, str(attempt)]).encode()).hexdigest()
    h = hashlib.sha256((key + h).encode()).hexdigest()
    number = lambda at, most: (int(h[at * 2 % 62 :][:4], 16) + at // 31 * 7) % most

    def spelled(text):
        out = ""
        for at, c in enumerate(text):
            digits = "0123456789"
            some = digits + "abcdef" if kind == "secret" or (kind == "address 6" and c != ":") else digits if c in digits else "abcdefghijklmnopqrstuvwxyz" if c.isalpha() else c
            out += some[number(at, len(some))]
        return out

    if kind == "email":
        local, end = norm.rsplit(".", 1)
        return spelled("a" * (attempt // 8) + local) + "." + end
    if kind == "address":
        return ".".join(str(number(i, 254) + 1) for i in range(4))
    if kind == "address 6":
        return spelled(norm + ":0000" * (attempt // 32) * ("::" in norm))
    if kind == "family" or kind.startswith("given"):
        cyrillic = regex.search(r"\p{Cyrillic}", norm) is not None
        syllables = s._CYRILLIC if cyrillic else s._LATIN
        size = min(max(len(norm) - 5, 1), 4) + attempt // 8 + 1
        return "".join(syllables[number(i, 32)] for i in range(size)) + s._ENDS[kind][cyrillic]
    made = spelled(norm + "0" * (attempt // 32))
    if kind == "card" and luhn(norm) == 0:
        made = next(made[:-1] + d for d in "0123456789" if luhn(made[:-1] + d) == 0)
    return made


def plain_entities(match):
    """Kind and norm of each part, with what stands around it and how it is written."""
    title = regex.match(rf"({s._TITLE})\.?[ \t]+", match)
    if title and "@" not in match:
        sex = next(k for k, of in s.TITLES.items() if title[1] in of)
        parts = match[title.end() :].split()
        for i, part in enumerate(parts):
            norm = regex.sub(r"[^\p{L}\p{N}]", "", part).lower()
            if i < len(parts) - 1:
                yield f"given {sex}", norm, part, ""
                continue
            mens = regex.sub(r"(?<=..[сц]к)ая$", "ий", regex.sub(r"(?<=..(?:[оеё]в|[иы]н))а$", "", norm))
            womens = sex == "f" or (sex == "n" and mens != norm)
            yield "family", mens, part, "а" if womens and regex.search(r"\p{Cyrillic}", norm) else ""
        return
    bare = regex.sub(r"[^\p{L}\p{N}]", "", match).lower()
    if "@" in match:
        yield "email", match.lower(), match, ""
    elif ":" in match:
        yield "address 6", match.lower(), match, ""
    elif match.count(".") == 3 and bare.isdigit():
        yield "address", match, match, ""
    elif match[0] in "+(" or re.fullmatch(r"\d{3}[.-]\d{3}[.-]\d{4}|0\d{2,4}[ /-]\d{5,8}", match):
        yield "phone", bare, match, ""
    elif re.fullmatch(r"\d{3}-\d{2}-\d{4}", match):
        yield "person number", bare, match, ""
    elif bare.isdigit() and len(bare) <= 26:
        yield "card", bare, match, ""
    else:
        yield "secret" if re.fullmatch("[0-9A-Fa-f]{32,}", match) else "account", bare, match, ""


def plain(texts, key):
    pattern = regex.compile(s.ENTITY.replace("(?U)", "").replace(r"\h", r"[ \t]"))
    real = {e[:2] for t in texts for m in pattern.findall(t or "") for e in plain_entities(m)}
    attempt = dict.fromkeys(real, 0)
    while True:
        made = {e: plain_surrogate(key, *e, n) for e, n in attempt.items()}
        first = {}
        for e in sorted(real, key=lambda e: (attempt[e], e[1])):
            first.setdefault((e[0], made[e]), e)
        again = [e for e in real if first[e[0], made[e]] != e or (e[0], made[e]) in real]
        if not again:
            break
        for e in again:
            attempt[e] += 1

    def new(match):
        out = []
        for kind, norm, written, end in plain_entities(match[0]):
            text = made[kind, norm] + end
            if kind == "family" or kind.startswith("given"):
                text = text.upper() if regex.match(r"\p{Lu}\p{Lu}+$", written) else text.capitalize()
            elif kind in ("secret", "address 6") and not re.search("[A-F]", written):
                pass
            elif kind in ("secret", "address 6") and not re.search("[a-f]", written):
                text = text.upper()
            elif kind not in ("email", "address", "address 6"):
                left = iter(text)
                text = "".join(c if not regex.match(r"[\p{L}\p{N}]", c) else x.upper() if c.isupper() else x for c in written for x in [next(left) if regex.match(r"[\p{L}\p{N}]", c) else ""])
                text += "".join(left)
            out.append(text)
        title = regex.match(rf"({s._TITLE})\.?[ \t]+", match[0])
        return (title[0] if title and kind in ("family",) else "") + " ".join(out)

    return [t and pattern.sub(new, t) for t in texts]


def test_equals_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/../sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-i - 1, text) for i, (_, text) in enumerate([*ROWS, *MORE])]
    wanted = dict(zip([i for i, _ in rows], plain([t for _, t in rows], "k")))
    got = s.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    assert len(got) == len(rows) and sum(r.n_entities for r in got) > 100
    assert [(r.doc_id, r.text) for r in got if r.text != wanted[r.doc_id]] == []


def test_numbers_addresses_and_womens_names(spark):
    got = {r.doc_id: r.text for r in replaced(spark, MORE)}
    phones = re.fullmatch(r"Call (\d{3}-\d{3}-\d{4}) or \((\d{3}\) \d{3}-\d{4}) or (\d{3} \d{7}); not 555-1234 nor .*", got[10])
    assert phones[1] == phones[2].replace(") ", "-") != "555-123-4567" and phones[3] != "030 1234567"
    hosts = re.fullmatch(r"From (\w+:\w+::\w) and (\w+:\w+::\w), (\w{4}(?::\w){7}) or (\w{4}(?::\w){7}); not 12:30:45, a::b, std::c1\.", got[11])
    assert hosts[1] == hosts[2].lower() and hosts[3] == hosts[4].upper() and hosts[1] != "2001:db8::1"
    names = re.fullmatch(r"Госпожа \w+ (\w+) и Господин \w+ (\w+), Dr\. (\w+), Prof\. (\w+), Господин (\w+), Dr (\w+)", got[12])
    assert names[1] == names[3] == names[2] + "а" and names[4] == names[5] + "а" and names[6][-1] == "в" and names[2] != names[5]


def test_short_mails_grow_where_all_are_taken(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"{a}@{b}.co") for i, (a, b) in enumerate((a, b) for a in letters for b in letters)]
    made = [r.text for r in replaced(spark, rows)]
    assert len(set(made)) == len(rows) and not set(made) & {t for _, t in rows}
    assert all(re.fullmatch(r"[a-z]{2,3}@[a-z]\.co|[a-z]{1,3}@[a-z]\.co", m) for m in made)
