"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

A surrogate keeps what the original looks like: digits become digits, letters letters of
the same case, separators, country prefixes, mail domains' shape, checksums, the title's
gender and the script stay.  The same entity gets the same surrogate everywhere
(coreference), different entities different ones (distinctness).  Format ciphers are
permutations, names are drawn by a keyed hash; a job over the distinct entities of the
corpus checks for surrogates that meet each other or an original, and draws again.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrears.llm.common import give_back, on_executors, pieces, texts, written

KINDS = ("email", "phone", "ip", "card", "ssn", "secret", "name")
#: key of the named query; a real job passes its own secret
DEFAULT_KEY = "replace me in production"
#: exceptions of the collision check that go to all tasks at most; more of them are joined
BROADCAST_EXCEPTIONS = 50_000

# Given names by gender and script, titles by gender.
GIVEN_NAMES = {
    ("m", "latin"): ("James", "Robert", "Peter", "Daniel", "Carlos", "Miguel", "Jean", "Pierre", "Hans", "Karl", "Lukas", "Oscar"),
    ("f", "latin"): ("Mary", "Anna", "Laura", "Julia", "Carmen", "Elena", "Claire", "Sophie", "Greta", "Clara", "Emma", "Nora"),
    ("m", "cyrillic"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай"),
    ("f", "cyrillic"): ("Анна", "Мария", "Елена", "Ольга", "Ирина", "Наталья"),
}
TITLES = {
    "m": ("Mr", "Señor", "Sr", "Monsieur", "Herr", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Señora", "Sra", "Madame", "Mme", "Frau", "Госпожа"),
    "": ("Dr", "Prof"),
}
_SYLLABLES = {
    "latin": ("bar", "den", "fel", "gor", "hal", "jon", "kel", "lin", "mor", "nar", "per", "ros", "sal", "tor", "val", "wen"),
    "cyrillic": ("бар", "вел", "гор", "дан", "жил", "зим", "кар", "лин", "мор", "нов", "пет", "рос", "сав", "тур", "фед", "чер"),
}
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_NAME = r"[^\W\d_a-zа-яß-ÿ][^\W\d_]+"

#: one pattern, types in order of preference at the same place
DETECTOR = re.compile(
    r"(?P<email>[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,})"
    r"|(?P<secret>(?:(?i:token|secret|api[_\- ]?key|access[_\- ]?key)[\"']?\s*[=:]\s*[\"']?(?i:bearer\s+)?|(?<!\w)(?i:bearer)\s+)"
    r"(?P<value>[A-Za-z0-9+/_\-]{12,}(?:\.[A-Za-z0-9+/_\-]+)*={0,2}|[A-Za-z0-9+/_\-]+(?:\.[A-Za-z0-9+/_\-]{6,}){2,}={0,2})"
    r"|(?i:password|passwd|pwd)[\"']?\s*[=:]\s*(?:\"(?P<quoted>[^\"\s]{4,})\"|'(?P<single>[^'\s]{4,})'|(?P<bare>[^\s\"',;]{4,})))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<phone>(?<![\w+])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[.\-])\d{3,4}[ .\-]\d{3,4}(?![\w]|-\d)"
    r"|\+\d{1,3}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d){6,12}(?![\w]|-\d)"
    r"|(?<!\d[ .\-])\d{3} \d{3} \d{4}(?![\w]|[ \-]\d)))"
    r"|(?P<ssn>(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w]|-\d))"
    r"|(?P<card>(?<![\w])\d(?:[ \-]?\d){12,18}(?![\w]))"
    rf"|(?P<name>(?<!\w)(?P<title>{'|'.join(sorted(_GENDER, key=len, reverse=True))})(?P<dot>\.? +)(?P<who>{_NAME}(?:[ \-]{_NAME}){{0,2}}))"
)
_WORD = re.compile(r"[^\W\d_]+")
_NEXT = re.compile(r"[ \-][^\W\d_]+")
#: every match holds one of these; a text without them is left alone at once
_HINT = re.compile(rf"[@\d]|(?i:token|secret|passw|pwd|key|bearer)|(?<!\w)(?:{'|'.join(sorted(_GENDER, key=len, reverse=True))})(?!\w)")


def _titled(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``found`` without later mentions of the names."""
    for m in DETECTOR.finditer(text):
        kind = m.lastgroup if m.lastgroup in ("email", "ip", "phone", "ssn", "card") else None
        if kind:
            yield m.start(), m.end(), kind, m.group()
        elif m["secret"]:
            part = next(g for g in ("value", "quoted", "single", "bare") if m[g])
            yield m.start(part), m.end(part), "secret", m[part]
        elif m["who"]:
            yield m.start("who"), m.end("who"), "name_" + (_GENDER[m["title"]] or "u"), m["who"]


def found(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``(start, end, type, entity)`` of what a whole text holds, left to right without overlap.

    Names are seen after a title; their full form and their last word are then seen anywhere
    in the same text.
    """
    if not _HINT.search(text):
        return
    own = list(_titled(text))
    kinds: dict[str, str] = {}
    for _, _, kind, entity in own:
        if kind.startswith("name") and kinds.get(entity, "name_u") == "name_u":
            kinds[entity] = kind
    for entity in list(kinds):
        last = re.split(r"[ \-]", entity)[-1]
        kinds[last] = "name_s"  # a family name alone has no gender
    own = [(start, end, kinds[entity] if kind.startswith("name") else kind, entity) for start, end, kind, entity in own]
    if not kinds:
        yield from own
        return
    # any name at once: words are looked up, no pattern grows with the names of a text
    longest = max(len(re.split(r"[ \-]", n)) for n in kinds)
    at, k = 0, 0
    for m in _WORD.finditer(text):
        while k < len(own) and own[k][0] <= m.start():
            yield own[k]
            at = max(at, own[k][1])
            k += 1
        if m.start() < at or not m.group()[0].isalpha():
            continue
        best, end = None, m.end()
        for n in range(longest):
            if n:
                more = _NEXT.match(text, end)
                if not more:
                    break
                end = more.end()
            if k < len(own) and end > own[k][0]:
                break
            if text[m.start() : end] in kinds:
                best = end
        if best:
            name = text[m.start() : best]
            yield m.start(), best, kinds[name], name
            at = best
    yield from own[k:]


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    """Keyed bytes without end."""
    n = 0
    while True:
        yield from hmac.new(key, "\x1f".join((*parts, str(n))).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        n += 1


def _number(key: bytes, limit: int, *parts: str) -> int:
    digest = hmac.new(key, "\x1f".join(parts).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
    return int.from_bytes(digest[:16], "big") % limit


def permuted(key: bytes, value: int, limit: int, *parts: str) -> int:
    """A keyed permutation of ``range(limit)``: a balanced Feistel network, walked until inside."""
    if limit < 2:
        return value
    bits = max(2, (limit - 1).bit_length())
    half = (bits + 1) // 2
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(6):
            left, right = right, left ^ (_number(key, mask + 1, *parts, str(r), str(right)))
        value = left << half | right
        if value < limit:
            return value


def _digits(key: bytes, entity: str, kind: str, attempt: int, skip: int = 0) -> str:
    """The digits after the first ``skip`` ones exchanged, everything else kept."""
    places = [i for i, c in enumerate(entity) if c.isdigit()][skip:]
    number = "".join(entity[i] for i in places)
    shape = "".join("0" if c.isdigit() else c for c in entity)
    fixed = "".join(c for c in entity if c.isdigit())[:skip]
    new = permuted(key, int(number), 10 ** len(number), kind, shape, fixed, str(attempt))
    if new == int(number):
        new = permuted(key, new, 10 ** len(number), kind, shape, fixed, str(attempt), "again")
    out = list(entity)
    for i, d in zip(places, str(new).zfill(len(number))):
        out[i] = d
    return "".join(out)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(key: bytes, entity: str, attempt: int) -> str:
    """Digits exchanged; a valid check digit stays valid and an invalid one invalid by as much."""
    digits = [i for i, c in enumerate(entity) if c.isdigit()]
    body = "".join(entity[i] for i in digits[:-1])
    off = (int(entity[digits[-1]]) - _luhn(body)) % 10
    new = _digits(key, entity[: digits[-1]], "card", attempt)
    check = (_luhn("".join(c for c in new if c.isdigit())) + off) % 10
    return new + str(check) + entity[digits[-1] + 1 :]


def _ip(key: bytes, entity: str, attempt: int) -> str:
    value = 0
    for octet in entity.split("."):
        value = value << 8 | int(octet)
    new = permuted(key, value, 1 << 32, "ip", str(attempt))
    return ".".join(str(new >> s & 255) for s in (24, 16, 8, 0))


def _characters(key: bytes, entity: str, kind: str, attempt: int) -> str:
    """Each letter for one of its case and each digit for a digit; hexadecimal stays hexadecimal."""
    hexa = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", entity) is not None and re.search("[a-fA-F]", entity)
    spaces = {"d": "0123456789", "l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    if hexa:
        low = entity == entity.lower()
        width = len(entity)
        new = permuted(key, int(entity, 16), 16**width, kind, "hex", str(width), str(attempt))
        return f"{new:0{width}{'x' if low else 'X'}}"
    radix, value, classes = 1, 0, []
    for c in entity:
        kind_of = "d" if c in spaces["d"] else "l" if c in spaces["l"] else "u" if c in spaces["u"] else ""
        classes.append(kind_of)
        if kind_of:
            value = value * len(spaces[kind_of]) + spaces[kind_of].index(c)
            radix *= len(spaces[kind_of])
    shape = "".join(k or c for k, c in zip(classes, entity))
    new = permuted(key, value, radix, kind, shape, str(attempt))
    out = []
    for c, k in zip(reversed(entity), reversed(classes)):
        if k:
            new, d = divmod(new, len(spaces[k]))
            out.append(spaces[k][d])
        else:
            out.append(c)
    return "".join(reversed(out))


def _email(key: bytes, entity: str, attempt: int) -> str:
    """Local part and domain exchanged on their own: addresses of one domain keep one domain."""
    local, _, domain = entity.partition("@")
    host, _, top = domain.rpartition(".")
    return f"{_characters(key, local, 'mail ' + domain, attempt)}@{_characters(key, host, 'host', 0)}.{top}"


def _name(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """Words for words: a given name of the gender and script where there are several, then family names."""
    script = "cyrillic" if any("CYRILLIC" in unicodedata.name(c, "") for c in entity[:1]) else "latin"
    parts = re.split(r"([ \-])", entity)
    gender = kind[-1]
    out = []
    for i, part in enumerate(parts):
        if i % 2:
            out.append(part)
            continue
        # a family name draws alike after any title and given name
        # and stays while other given names are tried
        last = i == len(parts) - 1
        turn = attempt if len(parts) == 1 else attempt // 2
        pick = _stream(key, "family", part, str(turn)) if last else _stream(key, kind, entity, str(attempt), str(i))
        if i == 0 and len(parts) > 1:
            names = GIVEN_NAMES[(gender, script)] if gender != "u" else GIVEN_NAMES[("m", script)] + GIVEN_NAMES[("f", script)]
            out.append(names[_number(key, len(names), kind, entity, str(attempt))])
        else:
            # each failed draw makes room for sixteen times as many names
            count = 2 + (len(part) > 6) + (turn if last else attempt // 2)
            out.append("".join(_SYLLABLES[script][next(pick) % 16] for _ in range(count)).capitalize())
        if part.isupper():
            out[-1] = out[-1].upper()
    return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of an entity; ``attempt`` counts the draws after collisions."""
    if kind == "email":
        return _email(key, entity, attempt)
    if kind == "ip":
        return _ip(key, entity, attempt)
    if kind == "card":
        return _card(key, entity, attempt)
    if kind == "phone":
        lead = re.match(r"\+(?:\d{1,3}(?=\D)|[17]|\d\d)", entity)
        return _digits(key, entity, kind, attempt, len(lead.group()) - 1 if lead else 0)
    if kind == "ssn":
        return _digits(key, entity, kind, attempt)
    if kind == "secret":
        return _characters(key, entity, kind, attempt)
    return _name(key, kind, entity, attempt)


def group_of(kind: str) -> str:
    return "name" if kind.startswith("name") else kind


def replaced(text: str, key: bytes, drawn: dict[tuple[str, str], int] | None = None, known: dict | None = None) -> tuple[str, Counter]:
    """A text with its entities replaced, and how many of each type there were."""
    out, at, counts = [], 0, Counter()
    for start, end, kind, entity in found(text):
        attempt = (drawn or {}).get((kind, entity), 0)
        new = (known or {}).get((kind, entity))
        if new is None:
            new = surrogate(key, kind, entity, attempt)
            if known is not None:
                if len(known) > 20_000:
                    known.clear()
                known[(kind, entity)] = new
        out += [text[at:start], new]
        at = end
        counts[group_of(kind)] += 1
    return ("".join(out) + text[at:]) if out else text, counts


def entities(docs: DataFrame) -> DataFrame:
    """Distinct ``(kind, entity)`` of all whole texts of ``docs(text)``; each task sends an entity once per batch."""
    on_executors(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            own = sorted({(k, e) for t in texts(batch.column(0)) for _, _, k, e in found(t)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in own], pa.string()), pa.array([e for _, e in own], pa.string())],
                ["kind", "entity"],
            )

    return docs.select("text").mapInArrow(work, "kind string, entity string").distinct()


def collisions(known: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """``(kind, entity, attempt)`` of the entities whose first surrogate is not theirs alone.

    ``known(kind, entity)`` are the distinct entities.  A draw fails if it equals an original
    of any kind or if an entity that comes first by (attempt, kind, entity) drew the same.
    Failed ones draw again until none is left.  Groups of equal draws are told apart by
    aggregates and joins, never collected.
    """
    spark = known.sparkSession
    on_executors(spark)
    secret = key.encode()

    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(secret, k, e, a) for k, e, a in zip(kind, entity, attempt)], dtype=object)

    state = written(
        known.withColumn("attempt", F.lit(0)).withColumn("new", draw("kind", "entity", "attempt")), "surrogates"
    )
    originals = known.select(F.col("entity").alias("new")).distinct()
    for _ in range(max_rounds):
        first = state.groupBy("new").agg(F.min(F.struct("attempt", "kind", "entity")).alias("first"), F.count(F.lit(1)).alias("n"))
        # only draws that failed are kept: later ones of equal draws, and all that meet an original
        shared = first.filter("n > 1").select("new", "first")
        later = state.join(shared, "new").filter(F.struct("attempt", "kind", "entity") != F.col("first")).select("kind", "entity")
        met = state.join(originals, "new", "left_semi").select("kind", "entity")
        failed = written(later.unionByName(met).distinct(), "failed-draws")
        if failed.isEmpty():
            break
        again = state.join(failed.withColumn("failed", F.lit(1)), ["kind", "entity"], "left")
        again = again.withColumn("attempt", F.col("attempt") + F.coalesce("failed", F.lit(0)))
        drawn = F.when(F.col("failed").isNotNull(), draw("kind", "entity", "attempt")).otherwise(F.col("new"))
        state = written(again.withColumn("new", drawn).drop("failed"), "surrogates")
    else:
        raise RuntimeError(f"surrogates still collide after {max_rounds} draws")
    return state.filter("attempt > 0").select("kind", "entity", "attempt")


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` replaced, ``n_chars`` following where it is a column, and ``__counts``.

    All columns and rows stay.  A null text stays null, texts without entities stay as they
    are, repeated rows get the same result, an empty table gives an empty result.  Entities
    whose draw collided reach the tasks as one small table if they are at most
    ``BROADCAST_EXCEPTIONS``; beyond that they are joined by the documents that hold them.
    """
    spark = docs.sparkSession
    on_executors(spark)
    secret = key.encode()
    redrawn = written(collisions(written(entities(docs), "entities"), key), "redrawn")
    few = redrawn.limit(BROADCAST_EXCEPTIONS + 1).collect()
    answer = "text string, counts map<string,int>"

    if len(few) <= BROADCAST_EXCEPTIONS:
        drawn = spark.sparkContext.broadcast({(r["kind"], r["entity"]): r["attempt"] for r in few})

        @F.pandas_udf(answer)
        def rewrite(text: pd.Series) -> pd.DataFrame:
            known: dict = {}
            rows = [(None, {}) if t is None else replaced(t, secret, drawn.value, known) for t in text]
            give_back()
            return pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object), "counts": pd.Series([dict(c) for _, c in rows], dtype=object)})

        changed = docs.withColumn("__new", rewrite("text"))
    else:
        hashed = docs.withColumn("__text", F.xxhash64("text"))

        @F.pandas_udf("array<struct<kind:string,entity:string>>")
        def held(text: pd.Series) -> pd.Series:
            return pd.Series([[{"kind": k, "entity": e} for k, e in sorted({x[2:] for x in found(t or "")})] for t in text], dtype=object)

        mentions = hashed.select("__text", F.explode(held("text")).alias("m")).select("__text", "m.kind", "m.entity").distinct()
        own = (
            mentions.join(redrawn, ["kind", "entity"]).groupBy("__text")
            .agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("__redrawn"))
        )

        @F.pandas_udf(answer)
        def rewrite_own(text: pd.Series, redrawn_: pd.Series) -> pd.DataFrame:
            rows = []
            for t, some in zip(text, redrawn_):
                tries = {(x["kind"], x["entity"]): x["attempt"] for x in (some if some is not None else ())}
                rows.append((None, {}) if t is None else replaced(t, secret, tries))
            return pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object), "counts": pd.Series([dict(c) for _, c in rows], dtype=object)})

        changed = hashed.join(own, "__text", "left").withColumn("__new", rewrite_own("text", "__redrawn")).drop("__text", "__redrawn")
    out = changed.withColumn("text", F.col("__new.text")).withColumn("__counts", F.col("__new.counts")).drop("__new")
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out
