"""Personal data replaced by keyed surrogates.

Entities are found by patterns and checks (Luhn, IBAN remainder, octets). Each gets a replacement of its own kind: the
digits, letters, case and punctuation of the original form, valid check digits, the same network class, the same
country prefix, names of the same gender and script. The replacement is drawn from a keyed hash of kind, canonical form
and attempt, so one entity has one surrogate in all documents and in all its spellings.

Two entities of a kind may draw the same surrogate, and a surrogate may be the canonical form of a real
entity. Both are found on the table of distinct entities: the smallest canonical form keeps a shared draw, and
the others draw again, until none is left. Only entities that needed a further attempt are joined back to documents;
all others are drawn again where the text is rewritten.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import put_back, set_aside
from basketlens.plans.workspace import written

# ---- names (fixed values: given names by script and gender, parts of family names by script) -------------------

GIVEN = {
    "latin": {
        "f": "Anna Clara Elena Emma Eva Greta Ida Jana Julia Laura Lena Lucia Maria Marta Nina Nora Olga Paula Rosa "
        "Sara Silvia Sofia Teresa Vera".split(),
        "m": "Adam Anton Bruno Carlos Daniel David Emil Felix Hugo Ivan Jakob Jonas Jorge Karl Lukas Marco Martin "
        "Oscar Pablo Paul Peter Simon Tomas Viktor".split(),
    },
    "cyrillic": {
        "f": "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Светлана Софья Юлия".split(),
        "m": "Алексей Борис Виктор Дмитрий Иван Максим Михаил Николай Олег Павел Сергей Юрий".split(),
    },
    "greek": {
        "f": "Άννα Ελένη Ειρήνη Κατερίνα Μαρία Νίκη Σοφία Χριστίνα".split(),
        "m": "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος Σταύρος".split(),
    },
}
FAMILY = {
    "latin": (
        "Ald Bar Bel Cor Dal Ern Fal Gar Hal Hol Kar Lan Mar Nor Ost Per Ros Sal Tor Val Ver Wal Wen Zim".split(),
        "bach berg dorf feld heim holm land lund mann more nell quist sen ski son stein ton vic vell wood".split(),
    ),
    "cyrillic": (
        "Бел Вол Гор Дол Зим Кар Лав Мор Нов Пол Рос Сол Тих Фед Чер Яр".split(),
        "анов енко ин ицкий ович ский ук юк".split(),
    ),
    "greek": (
        "Αλεξ Βασιλ Γεωργ Δημητρ Καρ Λαμπρ Μαρκ Νικολ Παπ Σταμ".split(),
        "άκης ίδης όπουλος άδης άτος έας".split(),
    ),
}
TITLES = {
    "m": "Mr Herr Señor Sr Monsieur Signor г-н κ".split(),
    "f": "Mrs Ms Miss Frau Señora Sra Madame Mme Signora г-жа κα".split(),
    "": "Dr Prof".split(),
}

_UPPER = r"A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈΉΊΌΎΏ"
_LOWER = r"a-zß-öø-ÿа-яёα-ωάέήίόύώς"
_NAME = rf"[{_UPPER}][{_LOWER}]+(?:[-'’][{_UPPER}][{_LOWER}]+)*"
_TITLE = "|".join(re.escape(t) for names in TITLES.values() for t in sorted(names, key=len, reverse=True))
_INTRO = r"(?:[Mm]y name is|[Nn]ame:|[Mm]e llamo|[Ii]ch heiße|[Jj]e m'appelle|[Мм]еня зовут|[Мм]ε λένε)"

# ---- finding -------------------------------------------------------------------------------------------------

# Addresses that are no one's: unset, the loopback and the broadcast.
_NOBODY = ([0, 0, 0, 0], [127, 0, 0, 1], [255, 255, 255, 255])
# First octets with networks of a special kind; such an address keeps its first octet.
_SPECIAL = {0, 10, 100, 127, 169, 172, 192, 198, 203, *range(224, 256)}
# Alternatives in order of precedence; the group names are the kinds.
_PATTERN = re.compile(
    rf"""
      (?P<email>(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{{2,}}(?![\w]))
    | (?P<aws>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{{16}}(?![A-Za-z0-9]))
    | (?P<github>(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{{36,}}(?![A-Za-z0-9]))
    | (?P<secret>(?i:password|passwd|pwd|token|secret|api[_-]?key)["']?\s*[:=]\s*["']?(?P<value>[\w/+=.-]{{8,}}))
    | (?P<iban>(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))
    | (?P<ipv4>(?<![\w.])(?:[0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}(?![\w]|\.[0-9]))
    | (?P<ssn>(?<![\w-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![\w-]))
    | (?P<card>(?<![\w-])[0-9](?:[ -]?[0-9]){{12,18}}(?![\w-]))
    | (?P<phone>(?<![\w+.])(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{2,4}}\)[ .-]?|[0-9]{{2,4}}[ .-])[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}(?![\w-]))
    | (?P<phone2>(?<![\w+.])\+[0-9]{{8,15}}(?![\w-]))
    | (?P<person>(?:(?<!\w)(?P<title>{_TITLE})\.?[ ]|{_INTRO}[ ])(?P<name>{_NAME}(?:[ ]{_NAME}){{0,2}}))
    """,
    re.VERBOSE,
)
# Digits grouped like a phone number that are years or a round number instead.
_NUMBERS = re.compile(r"(?:(?:19|20)[0-9]{2}[ .-]?){2,}|[0-9]{1,3}(?:[ .][0-9]{3})*[ .]000")
# A text without any of these has no entity.
_HINT = re.compile(rf"[0-9@=]|(?<!\w)(?:{_TITLE})\.? |{_INTRO}|(?i:password|passwd|pwd|token|secret|key)")


@dataclass(slots=True)
class Entity:
    """A stretch of text; ``canon`` is the same for all spellings of one entity."""

    kind: str
    canon: str
    start: int
    end: int


def _luhn(digits: str) -> int:
    """The remainder by 10 of the sum of Luhn's check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script_of(name: str) -> str:
    first = ord(name[0])
    return "greek" if 0x370 <= first < 0x400 else "cyrillic" if 0x400 <= first < 0x530 else "latin"


_GENDER = {n.casefold(): g for by_gender in GIVEN.values() for g, names in by_gender.items() for n in names}


def _phone(digits: str) -> str:
    """The national number: without the country's 1, if it has one."""
    return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits


def find(text: str | None) -> list[Entity]:
    """The entities of a text in order, without overlaps."""
    if not text or not _HINT.search(text):
        return []
    out: list[Entity] = []
    people: dict[str, str] = {}
    for m in _PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("value", "title", "name") else None
        kind = kind or ("secret" if m["secret"] else "person")
        word = m[0]
        if kind == "email":
            out.append(Entity(kind, word.lower(), *m.span()))
        elif kind in ("aws", "github"):
            out.append(Entity(kind, word, *m.span()))
        elif kind == "secret":
            value = m["value"].rstrip(".")
            if len(value) >= 8 and re.search(r"[0-9]", value):
                out.append(Entity(kind, value, m.start("value"), m.start("value") + len(value)))
        elif kind == "iban":
            plain = word.replace(" ", "")
            if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
                out.append(Entity(kind, plain, *m.span()))
        elif kind == "ipv4":
            octets = [int(o) for o in word.split(".")]
            if max(octets) < 256 and octets not in _NOBODY:
                out.append(Entity(kind, ".".join(map(str, octets)), *m.span()))
        elif kind == "ssn":
            out.append(Entity(kind, word.replace("-", ""), *m.span()))
        elif kind == "card":
            digits = re.sub(r"[ -]", "", word)
            if _luhn(digits) == 0 and len(set(digits)) > 1:
                out.append(Entity(kind, digits, *m.span()))
        elif kind in ("phone", "phone2"):
            digits = re.sub(r"\D", "", word)
            if 8 <= len(digits) <= 15 and not _NUMBERS.fullmatch(word):
                out.append(Entity("phone", _phone(digits), *m.span()))
        else:
            _person(m, out, people)
    if people:
        _mentions(text, out, people)
        out.sort(key=lambda e: e.start)
    return out


def _person(m: re.Match, out: list[Entity], people: dict[str, str]) -> None:
    names = m["name"].split(" ")
    gender = next((g for g, titles in TITLES.items() if m["title"] in titles), "")
    at = m.start("name")
    for i, name in enumerate(names):
        known = _GENDER.get(name.casefold())
        given = len(names) > 1 and i < len(names) - 1 or len(names) == 1 and bool(known)
        kind = f"given-{known or gender or 'n'}-{script_of(name)}" if given else f"family-{script_of(name)}"
        out.append(Entity(kind, name.casefold(), at, at + len(name)))
        people.setdefault(name, kind)
        at += len(name) + 1


# A word that may hold names, and its parts.
_CAPITAL = re.compile(rf"(?<!\w)[{_UPPER}]\w*(?:[-'’]\w+)*")
_PART = re.compile(r"\w+")


def _mentions(text: str, out: list[Entity], people: dict[str, str]) -> None:
    """Other mentions of people who were introduced in the text: whole parts of words, the longest name at a place."""
    longest = max(len(_PART.findall(name)) for name in people)
    starts, ends = [e.start for e in out], [e.end for e in out]
    for word in _CAPITAL.finditer(text):
        parts = [m.span() for m in _PART.finditer(text, *word.span())]
        i = 0
        while i < len(parts):
            for j in range(min(i + longest, len(parts)), i, -1):
                start, end = parts[i][0], parts[j - 1][1]
                if text[start:end] not in people:
                    continue
                at = bisect_right(starts, start)
                if not (at and ends[at - 1] > start) and not (at < len(starts) and starts[at] < end):
                    name = text[start:end]
                    out.append(Entity(people[name], name.casefold(), start, end))
                i = j - 1
                break
            i += 1


# ---- drawing -------------------------------------------------------------------------------------------------


class Draw:
    """Numbers from a keyed hash of what they are drawn for."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.key, self.parts, self.block = key, "\x00".join(parts).encode(), 0
        self.number = 0
        self.room = 1

    def below(self, n: int) -> int:
        if self.room < n << 64:
            block = hashlib.blake2b(self.parts, key=self.key, salt=self.block.to_bytes(8, "little")).digest()
            self.number, self.room, self.block = int.from_bytes(block, "little"), 1 << 512, self.block + 1
        self.number, out = divmod(self.number, n)
        self.room //= n
        return out

    def same_form(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case; everything else as it is."""
        return "".join(map(self._like, text))

    def _like(self, c: str) -> str:
        if "0" <= c <= "9":
            return chr(48 + self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        return chr(65 + self.below(26)) if "A" <= c <= "Z" else c


# Attempts after which a small private network counts as full, and after which a form without room is an error.
_LATE = 8
MAX_ATTEMPTS = 64


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The surrogate's canonical form. Names, mail addresses, hosts and secrets get longer every fourth attempt."""
    draw = Draw(key, kind, canon, str(attempt))
    longer = "x" * (attempt // 4)
    if kind == "email":
        # With the domain it has; that of the surrogate is drawn for the domain.
        local, at, domain = canon.rpartition("@")
        return draw.same_form(local + longer) + at + domain
    if kind == "domain":
        host, dot, top = canon.rpartition(".")
        return draw.same_form(host + longer) + dot + top
    if kind == "aws":
        return canon[:4] + draw.same_form(canon[4:])
    if kind == "github":
        return canon[:4] + draw.same_form(canon[4:])
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", canon):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in canon + longer)
        return draw.same_form(canon + longer)
    if kind == "iban":
        body = canon[:2] + "00" + draw.same_form(canon[4:])
        return body[:2] + f"{98 - _iban_rest(body):02d}" + body[4:]
    if kind == "ipv4":
        return _address(draw, [int(o) for o in canon.split(".")], attempt)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "card":
        body = canon[0] + "".join(str(draw.below(10)) for _ in canon[1:-1])
        return body + str(-_luhn(body + "0") % 10)
    if kind == "phone":
        country = canon[:2] if len(canon) > 10 else ""
        return country + str(2 + draw.below(8)) + draw.same_form(canon[len(country) + 1 :])
    role, *rest = kind.split("-")
    parts = attempt // 4 + 1
    if role == "given":
        gender, script = rest
        names = GIVEN[script].get(gender) or GIVEN[script]["f"] + GIVEN[script]["m"]
        return "-".join(names[draw.below(len(names))] for _ in range(parts)).casefold()
    heads, tails = FAMILY[rest[0]]
    return "-".join(heads[draw.below(len(heads))] + tails[draw.below(len(tails))] for _ in range(parts)).casefold()


def _address(draw: Draw, octets: list[int], attempt: int) -> str:
    """An address of the same class: private networks stay in theirs, public ones outside of them.

    A private network without room, as late attempts tell, goes on in the largest of them.
    """
    first, second = octets[:2]
    private = (first, second) == (192, 168) or first == 172 and 16 <= second < 32
    if first == 10 or private and attempt >= _LATE:
        new = [10, draw.below(256)]
    elif (first, second) == (192, 168):
        new = [192, 168]
    elif first == 172 and 16 <= second < 32:
        new = [172, 16 + draw.below(16)]
    elif first in _SPECIAL:
        new = [first, draw.below(256)]
    else:
        public = [n for n in range(1, 224) if n not in _SPECIAL]
        new = [public[draw.below(len(public))], draw.below(256)]
    return ".".join(map(str, [*new, draw.below(256), 1 + draw.below(254)]))


def in_form(kind: str, original: str, new: str) -> str:
    """The surrogate spelled as the original is: its separators, its prefix and its case."""
    if kind in ("card", "ssn", "phone", "iban"):
        if kind == "iban":
            left = iter(new)
            return "".join(next(left) if c.isalnum() else c for c in original)
        digits = sum(c.isdigit() for c in original)
        # A country prefix that the canonical form leaves out stays.
        left = iter([c for c in original if c.isdigit()][: digits - len(new)] + list(new))
        return "".join(next(left) if c.isdigit() else c for c in original)
    if kind == "email":
        same = len(original) == len(new)
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new)) if same else new
    if kind.startswith(("given", "family")):
        if original.isupper():
            return new.upper()
        return re.sub(r"(^|-)(\w)", lambda m: m[1] + m[2].upper(), new) if original[:1].isupper() else new
    return new


# ---- on tables -----------------------------------------------------------------------------------------------


def _entity_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _mark, kind, canon): the different entities of each document, and the domains of its mail addresses."""
    for batch in batches:
        out: list[tuple] = []
        for doc_id, mark, text in zip(*batch.columns):
            found = {(e.kind, e.canon) for e in find(text.as_py())}
            found |= {("domain", canon.rpartition("@")[2]) for kind, canon in found if kind == "email"}
            out += [(doc_id.as_py(), mark.as_py(), *e) for e in sorted(found)]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["_id", "_mark", "kind", "canon"])


def _draws(key: bytes, drawn: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns])
            new = pa.array([drawn(key, *row) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], [*batch.schema.names, "new"])

    return run


# Entities that a task draws for; fewer are not worth a task and a file.
_TASK_ROWS = 2_000


def _files(rows: int) -> int:
    return -(-rows // _TASK_ROWS)


def assign_surrogates(entities: DataFrame, key: bytes, drawn: Callable = surrogate) -> DataFrame:
    """(kind, canon, attempt, new) for every row of ``entities`` (kind, canon), which are distinct.

    Within a kind no two rows have the same ``new``; but for names, none is the canonical form of any row either
    (a list of names cannot avoid all names there are). A round settles all but those that collided. If a form has no room for
    all entities that have it, so that some still collide after MAX_ATTEMPTS, that is a ValueError.
    """
    schema = "kind string, canon string, attempt int, new string"
    entities = written(entities.select("kind", "canon"), "entities")
    real = entities.where(~F.col("kind").rlike("^(given|family)")).select("kind", F.col("canon").alias("new"))
    pending, left = entities.withColumn("attempt", F.lit(0)), entities.count()
    settled: DataFrame | None = None
    for _ in range(MAX_ATTEMPTS):
        tried = written(pending.mapInArrow(_draws(key, drawn), schema), "draws", _files(left))
        winners = tried.groupBy("kind", "new").agg(F.min("canon").alias("least")).join(real, ["kind", "new"], "left_anti")
        if settled is not None:
            winners = winners.join(settled.select("kind", "new"), ["kind", "new"], "left_anti")
        won = F.coalesce(F.col("canon") == F.col("least"), F.lit(False)).alias("won")
        judged = tried.join(winners, ["kind", "new"], "left").select("kind", "canon", "attempt", "new", won)
        judged = written(judged, "settled-or-collided", _files(left))
        now = judged.where("won").drop("won")
        settled = now if settled is None else settled.unionByName(now)
        pending = judged.where("NOT won").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        left = pending.count()
        if not left:
            return settled
    full = ", ".join(f"{r['count']} of {r['kind']}" for r in pending.groupBy("kind").count().orderBy("kind").collect())
    raise ValueError(f"no room for surrogates of the same form: {full}")


def _rewrite(key: bytes, drawn: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for value, again in zip(batch.column("text"), batch.column("_again")):
                text = value.as_py()
                attempts = {(a["kind"], a["canon"]): a["attempt"] for a in again.as_py() or ()}
                parts, at, seen = [], 0, set()
                found = find(text)
                for e in found:
                    new = drawn(key, e.kind, e.canon, attempts.get((e.kind, e.canon), 0))
                    if e.kind == "email":
                        local, _, domain = new.rpartition("@")
                        new = f"{local}@{drawn(key, 'domain', domain, attempts.get(('domain', domain), 0))}"
                    parts += [text[at : e.start], in_form(e.kind, text[e.start : e.end], new)]
                    at = e.end
                    seen.add(e.kind.partition("-")[0])
                texts.append("".join([*parts, text[at:]]) if found else text)
                counts.append(len(found))
                kinds.append(sorted(seen))
            place = batch.schema.get_field_index("text")
            done = batch.set_column(place, "text", pa.array(texts, pa.string())).drop_columns(["_again"])
            columns = [*done.columns, pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*done.schema.names, "n_entities", "kinds"])

    return run


def replace_entities(docs: DataFrame, key: bytes, drawn: Callable = surrogate) -> DataFrame:
    """``docs`` (doc_id, text, …) with the entities of ``text`` replaced, ``n_entities`` and ``kinds``.

    All rows stay, in all columns; columns of the two added names are replaced. Null texts stay null, and texts without
    entities stay as they are. Rows with equal doc_id (null or not) and text are the same document. ``key`` is
    secret (16 to 64 bytes): without it surrogates cannot be traced back or drawn again.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    own = docs.drop("n_entities", "kinds")
    keyed = own.select(
        set_aside(own).alias("_row"),
        F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_mark"),
    )
    rows = keyed.where(F.col("text").isNotNull()).select("_id", "_mark", "text")
    found = written(rows.mapInArrow(_entity_rows, "_id long, _mark long, kind string, canon string"), "entity-rows")
    files = _files(found.count())
    settled = assign_surrogates(found.select("kind", "canon").distinct().coalesce(max(1, files)), key, drawn)
    again = settled.where("attempt > 0").select("kind", "canon", "attempt")
    # Of documents only those matter that have an entity with a further attempt.
    by_doc = found.join(again, ["kind", "canon"]).groupBy("_id", "_mark")
    by_doc = written(by_doc.agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("_again")), "again-by-doc", files)
    there = by_doc.select(F.col("_id").alias("_id2"), F.col("_mark").alias("_mark2"), "_again")
    joined = keyed.join(there, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_mark") == F.col("_mark2")), "left")
    source = joined.select("_row", "text", "_again")
    added = [T.StructField("n_entities", T.LongType()), T.StructField("kinds", T.ArrayType(T.StringType()))]
    schema = T.StructType([*source.drop("_again").schema.fields, *added])
    done = source.mapInArrow(_rewrite(key, drawn), schema)
    return done.select(*put_back(own.columns, "_row"), "n_entities", "kinds")
