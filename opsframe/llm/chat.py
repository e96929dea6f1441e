"""Chat records of many layouts as canonical turns, and turns as formatted text with a loss mask.

A record is a JSON object.  The set of its nested field paths is hashed; the hash selects a declarative mapping
that says where the turns are.  Optional fields of a mapping give it several fingerprints.  In a path a backslash
stands before every dot, bracket and backslash that belongs to a name.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows passed on at once.
BATCH_ROWS = 2000

# Strings that mark turns in common chat templates.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"

# Names that layouts give to roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class One:
    """A turn of a fixed role whose text is at a path; it is left out where the text is missing and optional."""

    role: str
    text: str


@dataclass(frozen=True)
class Each:
    """A turn for each element of a list, with its role and text in fields of the element."""

    items: str
    role: str
    text: str


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps conversation, turn number and turns; ``optional`` lists paths that may be missing."""

    name: str
    turns: tuple
    conversation: str | None = None
    turn: str | None = None
    role: str | None = None
    optional: frozenset[str] = field(default=frozenset())

    def is_row(self) -> bool:
        """Whether a record is one turn and not a whole conversation."""
        return bool(self.role or self.turn)

    def paths(self) -> set[str]:
        found = {p for p in (self.conversation, self.turn, self.role) if p}
        for part in self.turns:
            if isinstance(part, Each):
                found |= {f"{part.items}[].{part.role}", f"{part.items}[].{part.text}"}
            else:
                found.add(part.text)
        return found


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256(json.dumps(sorted(set(paths))).encode()).hexdigest()


def field_paths(value, at: str | None = None) -> Iterator[str]:
    """The paths of all leaves; list elements share the path of their list with ``[]``."""
    if isinstance(value, dict) and value:
        for key, inner in value.items():
            name = re.sub(r"([\\.\[\]])", r"\\\1", key)
            yield from field_paths(inner, name if at is None else f"{at}.{name}")
    elif isinstance(value, list):
        if not value:
            yield f"{at or ''}[]"
        for inner in value:
            yield from field_paths(inner, f"{at or ''}[]")
    elif at is not None:  # the empty record has no path
        yield at


def fingerprints(mappings: Iterable[Mapping]) -> dict[str, Mapping]:
    """Every fingerprint that selects a mapping."""
    found: dict[str, Mapping] = {}
    for mapping in mappings:
        free = sorted(mapping.optional)
        for missing in itertools.chain.from_iterable(itertools.combinations(free, n) for n in range(len(free) + 1)):
            key = fingerprint((mapping.paths() | mapping.optional) - set(missing))
            if found.setdefault(key, mapping) is not mapping:
                raise ValueError(f"{mapping.name} and {found[key].name} have the same paths")
    return found


MAPPINGS = [
    Mapping("turn rows", (One("", "text"),), "conv_id", "turn", "role", frozenset({"conv_id", "turn", "role", "text"})),
    Mapping("messages", (Each("messages", "role", "content"),), "conv_id", optional=frozenset({"conv_id"})),
    Mapping("conversations", (Each("conversations", "from", "value"),), "id", optional=frozenset({"id"})),
    Mapping("prompt", (One("system", "system"), One("user", "prompt"), One("assistant", "completion")), "id",
            optional=frozenset({"id", "system"})),
    Mapping("instruction", (One("user", "instruction"), One("user", "input"), One("assistant", "output")), "id",
            optional=frozenset({"id", "input"})),
    Mapping("nested prompt", (One("user", "data.question"), One("assistant", "data.answer.text")), "meta.id",
            optional=frozenset({"meta.id"})),
]


def _names(path: str) -> list[str]:
    """The names a path consists of."""
    return [re.sub(r"\\(.)", r"\1", name) for name in re.findall(r"(?:^|(?<=\.))((?:[^\\.]|\\.)*)(?:\.|$)", path)]


def _at(record, path: str | None):
    for key in _names(path) if path else ():
        record = record.get(key) if isinstance(record, dict) else None
    return record if path else None


def _text(value) -> str:
    """Lone surrogates, which no text may hold, become U+FFFD."""
    plain = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return re.sub("[\ud800-\udfff]", "\ufffd", plain)


def _whole(value) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63 else None


def _turns(record: dict, mapping: Mapping) -> Iterator[tuple[int | None, str, str]]:
    """Number, role and text of each turn."""
    number = itertools.count()
    for part in mapping.turns:
        if isinstance(part, Each):
            for item in _at(record, part.items):
                role = _text(_at(item, part.role))
                yield next(number), ROLES.get(role, role), _text(_at(item, part.text))
        elif mapping.is_row():
            yield _whole(_at(record, mapping.turn)), _text(_at(record, mapping.role)), _text(_at(record, part.text))
        elif part.text not in mapping.optional or _at(record, part.text) is not None:
            yield next(number), part.role, _text(_at(record, part.text))


def canonical_turns(
    records: DataFrame, column: str = "record", mappings: list[Mapping] | None = None, record_id: str | None = None
) -> DataFrame:
    """``layout, fingerprint, conv_id, turn, role, text`` for every turn of JSON records.

    ``conv_id`` is text, so ids of any kind stay apart: strings as they are, whatever else as JSON writes it (7 and
    "7" are one id).  A record that is a whole conversation without an id has that of the column ``record_id``, if
    there is one, else a hash of the record; turns in rows of their own that name no conversation have a null id.

    Null texts and roles are empty; lone surrogates become U+FFFD; a turn number that is not whole or leaves 64 bits
    is null.  A record that is null, no JSON object or of an unknown layout gives one row with a null layout and
    nothing but its fingerprint (null if it is no object), so that it can be counted and mapped.  Equal records give
    equal turns, each as often as the record occurs.  Other columns are not looked at; no records give no row.
    """
    known = fingerprints(MAPPINGS if mappings is None else mappings)
    schema = "layout string, fingerprint string, conv_id string, turn bigint, role string, text string"
    arrow = pa.schema([("layout", pa.string()), ("fingerprint", pa.string()), ("conv_id", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def convert(text: str | None, given: str | None) -> Iterator[tuple]:
        try:
            record = json.loads(text) if text is not None else None
            key = fingerprint(field_paths(record)) if isinstance(record, dict) else None
        except (ValueError, RecursionError):
            record, key = None, None
        mapping = known.get(key)
        if mapping is None:
            yield None, key, None, None, None, None
            return
        conversation = _at(record, mapping.conversation)
        if conversation is not None:
            conversation = _text(conversation)
        elif not mapping.is_row():
            conversation = given if given is not None else f"record {hashlib.sha256(text.encode()).hexdigest()}"
        for turn, role, words in _turns(record, mapping):
            yield mapping.name, key, conversation, turn, role, words

    def batches_of(batches):
        for batch in batches:
            rows = itertools.chain.from_iterable(convert(x.as_py(), y.as_py()) for x, y in zip(*batch.columns))
            while part := list(itertools.islice(rows, BATCH_ROWS)):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part), arrow.types)], arrow)

    given = F.lit(None) if record_id is None else F.col(f"`{record_id}`")
    rows = records.select(F.col(f"`{column}`").cast("string").alias("record"), given.cast("string").alias("given"))
    return rows.mapInArrow(batches_of, schema)


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if c in r"\.[]{}()<>|*+?^$/" else c for c in text)


_BEGIN = "|".join(sorted({_quoted(c[0]) for c in CONTROL}))
_REST = "|".join(_quoted(c[1:]) for c in CONTROL)


def escape(text: Column) -> Column:
    """Breaks every control string by a backslash behind its first character, one more if there are some already."""
    return F.regexp_replace(text, rf"({_BEGIN})(\\*)(?={_REST})", r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_BEGIN})(\\*)\\(?={_REST})", "$1$2")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(unescape(role), r"\\\\", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, segment, loss_start, loss_chars``: the formatted text of each turn and what of it is learnt.

    The segments of a conversation in the order of its turns are its formatted text.  A segment is kept on a row
    of its own, so a conversation of any length fits.  The loss mask covers the text of assistant turns, in code
    points from ``loss_start``.
    """
    role, text = _escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    learnt = F.col("role").eqNullSafe("assistant").alias("_learnt")
    parts = turns.select("conv_id", "turn", learnt, role.alias("_role"), text.alias("_text"))
    head = F.concat(F.lit(TURN_START), "_role", F.lit("\n"))
    return parts.select(
        "conv_id",
        "turn",
        F.concat(head, "_text", F.lit(TURN_END)).alias("segment"),
        F.length(head).cast("long").alias("loss_start"),
        F.when(F.col("_learnt"), F.length("_text")).otherwise(0).cast("long").alias("loss_chars"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Turns and learnt texts as the formatted segments tell them: ``conv_id, turn, role, text, learnt, chars``."""
    body = F.substr("segment", F.lit(len(TURN_START) + 1), F.length("segment") - len(TURN_START) - len(TURN_END))
    role = F.substring_index("_body", "\n", 1)
    learnt = F.substr("segment", F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int"))
    return formatted.withColumn("_body", body).select(
        "conv_id",
        "turn",
        _unescape_role(role).alias("role"),
        unescape(F.substr("_body", F.length(role) + 2)).alias("text"),
        F.when(F.col("loss_chars") > 0, unescape(learnt)).otherwise("").alias("learnt"),
        F.length("segment").cast("long").alias("chars"),
    )


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, from turns as ``read_turns`` gives them.

    A task streams its conversations in order and holds running digests only.  Turns are ordered by number, null
    ones first, then by role and text; rows without ``conv_id`` are one conversation, which one task streams.
    """
    columns = ["conv_id", "turn", "role", "text", "learnt", "chars"]
    rows = turns.select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    fields = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def digest(batches):
        conversation, done, arrow = None, [], None

        def end():
            if conversation is not None:
                key, n, turns_sha, learnt, loss_sha, chars = conversation
                done.append((key, n, turns_sha.hexdigest(), learnt, loss_sha.hexdigest(), chars))

        def out():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), arrow.types)], arrow)

        for batch in batches:
            arrow = arrow or pa.schema([("conv_id", batch.schema.field("conv_id").type), *fields])
            for key, role, text, learnt, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "learnt", "chars"))):
                if conversation is None or conversation[0] != key:
                    end()
                    conversation = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                conversation[1] += 1
                conversation[2].update(f"{role}\n{text}\n".encode())
                conversation[3] += len(learnt)
                conversation[4].update(learnt.encode())
                conversation[5] += chars
            if done:
                yield out()
                done.clear()
        end()
        if done:
            yield out()

    return rows.mapInArrow(digest, schema)
