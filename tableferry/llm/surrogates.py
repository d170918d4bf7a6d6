"""Personal data replaced by keyed surrogates of the same kind and format.

An entity is what a pattern finds, in a normal form (digits of a number, lower-case address, name in one case), so
that its spellings are one entity.  Its surrogate depends on the key, the kind and the entity alone: it is the same
in every document.  All distinct entities are given surrogates together; where two would share one, or one is an
entity of the corpus itself, all but one of them (or that one) are drawn again until none is left.  The surrogate
is then written in the form of each place: its case, separators, country code, script, gender, check digit.

Names are found after forms of address, several in a row too, and titles without a gender.  A surname has one surrogate
whatever the form of address before it, and bare repetitions of it in the same text get the same; a given name's
surrogate shows the gender, where the title tells none that of the same surname elsewhere in the text.

Defined cases: null and empty texts, and texts without entities, stay as they are; repeated rows give repeated rows;
an empty table stays empty; all columns but the text are passed on.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.session import fresh_path

#: Draws after which a kind's format is taken to have no room left.
MAX_DRAWS = 40

# Forms of address by gender.
_MALE = ("Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н", "κύριος", "κ")
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "госпожа", "г-жа", "κυρία", "κα")
_EITHER = ("Dr", "Doctor", "Doktor", "Docteur", "Dott", "Prof", "Professor", "Professeur", "Mx", "д-р", "доктор", "проф", "профессор", "δρ", "καθ")
_GENDER = {x.lower(): "m" for x in _MALE} | {x.lower(): "f" for x in _FEMALE} | {x.lower(): "n" for x in _EITHER}
_TITLE = "|".join(sorted(map(re.escape, (*_MALE, *_FEMALE, *_EITHER)), key=len, reverse=True))
_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?:-[^\W\d_]+)?"

# Words before a secret, of any length in front, and beginnings of issued keys; what comes behind them is the entity.
_HEAD = r"(?i:(?:token|secret|password|passwd|pwd|passphrase|api[_ -]?key|access[_-]?key|private[_-]?key)[\"']?[ \t]{0,2}[=:][ \t]{0,2})"
_KEY = r"(?:sk-|[sr]k_(?:live|test)_|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|AKIA|ASIA|AIza)"

# An address, with what stands before it in its run of characters: sought once for each run, however long it is.
_ADDRESS = r"[._%+-]*(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
_REST_OF_RUN = re.compile(_ADDRESS)

# Words in capitals behind a form of address that make no name of it.
_ROLES = frozenset("""academy america architect chairman congress consultant designer developer director editor engineer executive
lecturer manager marketing minister officer president product professor program project recruiter scientist senior software
speaker supranational teenager universe vice world""".split())
# Calls and attributes in source code, which no secret looks like.
_CODE = re.compile(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*(?:[(\[][\w.]*[)\]]?)?")

_PATTERN = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_ADDRESS}"
    r"|(?P<secret>(?<![\w])[0-9a-f]{32,}(?![\w])|(?<![\w])[0-9A-F]{32,}(?![\w])"
    rf"|{_HEAD}(?:\"(?P<quoted>[^\s\"]{{8,}})(?=\")|'(?P<ticked>[^\s']{{8,}})(?=')|(?P<bare>(?:(?<=[=])|(?<=[=] )|(?=[^\s\"',;]*(?:[0-9]|[a-z][A-Z])))[^\s\"',;]{{8,}}))"
    rf"|(?<!\w){_KEY}(?P<rest>(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{{16,}}))"
    r"|(?P<ipsix>(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w@]|\.\d))"
    r"|(?P<card>(?<![\w.])(?:\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|3\d{3}[ -]\d{6}[ -]\d{5})(?![\w@]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}|(?<![+/-])(?:\(0[1-9]\d{0,3}\) ?|0[1-9]\d{0,3}[ /-])\d{2,8}(?:[ /-]\d{2,4}){0,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w@]|\.\d))"
    rf"|(?P<name>(?<!\w)(?:(?:{_TITLE})\.? )+(?!(?:{_TITLE})(?!\w))(?P<one>{_NAME})(?: (?P<two>{_NAME}))?)"
)
#: What a number can't end before: it would be a part of a longer word, address or number.
_KINDS = ("email", "secret", "ipsix", "ip", "iban", "card", "ssn", "phone", "name")
_GOES_ON = re.compile(r"[\w@]|\.\d")
_DIGITS = re.compile(r"\d+")
#: Digits of other scripts.
_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isdecimal())
# The last letters of the words before a secret, in any case.
_ENDS = "(?:[kK\u212a][eE][nNyY]|[rR][eE][tT]|[oO][rR][dD]|[sSpP\u017f][wW][dD]|[aA][sS\u017f][eE])"
#: One of these is in any text with an entity; other texts need no search.  The same in the engine's and in this language's
#: patterns: digits and addresses, words before secrets, long hex numbers of letters alone, other scripts' digits, forms of
#: address.  One after the other is faster in the engine than all in one; the first letters alone pass over most places.
MAYBE = (
    "[0-9@]",
    r"[=:](?:" + "|".join(rf"(?<={_ENDS}[ \t\"']{{{n}}}[=:])" for n in range(4)) + ")",
    "[a-fA-F]{32}",
    f"[{_OTHER_DIGITS[0]}-{_OTHER_DIGITS[-1]}](?<=[{_OTHER_DIGITS}])",
    rf"(?=[{"".join(sorted({x[0] for x in (*_MALE, *_FEMALE, *_EITHER)}))}])(?:{_TITLE})\.? ",
)
_MAYBE = re.compile("|".join(MAYBE))

_SYLLABLES = {"latin": (("ba", "be", "da", "do", "fe", "ga", "ha", "jo", "ka", "ke", "la", "le", "li", "ma", "mi", "no", "ra", "ri", "ro", "sa", "se", "ta", "ti", "va", "vi", "zo"), {"m": "n", "f": "a", "n": "er"}),
              "cyrillic": (("ба", "ве", "го", "да", "жи", "ка", "ло", "ма", "не", "по", "ра", "со", "та", "фе", "ха", "ши"), {"m": "н", "f": "я", "n": "ко"}),
              "greek": (("βα", "γε", "δα", "ζη", "θε", "κα", "λο", "μα", "νι", "πα", "ρο", "σα", "τε", "φι", "χα"), {"m": "ς", "f": "α", "n": "ης"})}


class Found(NamedTuple):
    start: int
    end: int
    kind: str
    entity: str


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0].lower()
    return name if name in _SYLLABLES else "latin"


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _groups(address: str) -> list[int]:
    """The eight numbers of an IPv6 address; too few or too many are taken as they are."""
    left, gap, right = address.partition("::")
    ahead, behind = ([int(x, 16) for x in part.split(":") if x] for part in (left, right))
    return [*ahead, *[0] * ((8 - len(ahead) - len(behind)) if gap else 0), *behind]


def _phone_end(text: str, start: int, end: int) -> int | None:
    """Where the number at ``start`` ends, ``end`` at most: with the fixed number of digits of its zone, or before the next
    entity, or with 7 to 15 digits; None if it is no phone."""
    ends, sure, likely, inside, digits = {}, None, None, False, 0
    for run in _DIGITS.finditer(text, start, end):
        other = _PATTERN.match(text, run.start()) if run.start() > start else None
        if other and other["phone"] and text[run.start()] == "0":
            other = None  # a group of this one
        inside = inside or other is not None
        if other and 7 <= digits <= 15 and text[run.start() - 1] == " ":
            # Four groups of a card may begin with the last of the phone's, unless its check digit is right.
            likely = digits
            if sure is None and (not other["card"] or luhn("".join(_DIGITS.findall(other[0])))):
                sure = digits
        digits += len(run[0])
        if 7 <= digits <= 15 and not _GOES_ON.match(text, run.end()):
            ends[digits] = run.end()
    if text[start] == "0" or text.startswith("(0", start):
        # Without a country code, shorter ones may be dates.
        ends = {k: v for k, v in ends.items() if k >= 9}
    if text[start:start + 2] in ("+1", "+7") and 11 in ends:
        return ends[11]
    if (cut := sure or likely) in ends:
        return ends[cut]
    # What is too long and holds something else, such as a card, is that.
    return ends[max(ends)] if ends and (digits <= 15 or not inside) else None


def _matches(text: str) -> Iterator[tuple[re.Match, int]]:
    """Matches with their ends; what turns out to be no entity is searched again behind its first character."""
    at = 0
    while True:
        m = _PATTERN.search(text, at)
        # What was found last may end inside a run, whose rest is an address.
        rest = _REST_OF_RUN.match(text, at) if at else None
        if rest and (m is None or rest.start("email") <= m.start()):
            m = rest
        if m is None:
            return
        end = _phone_end(text, *m.span()) if m.lastgroup == "phone" else m.end()
        if end is not None:
            yield m, end
        at = end or m.start() + 1


def find(text: str | None) -> list[Found]:
    """Entities in order, none over another."""
    if not text or not _MAYBE.search(text):
        return []
    out: list[Found] = []
    for m, end in _matches(text):
        kind, surface = next(k for k in _KINDS if m[k] is not None), text[m.start():end]
        if kind == "name":
            if m["one"].casefold() in _ROLES:
                continue
            titles = [_GENDER[x.rstrip(".").lower()] for x in text[m.start():m.start("one")].split()]
            gender = next((x for x in titles if x != "n"), "n")
            parts = ["one", "two"] if m["two"] else ["one"]
            for i, part in enumerate(parts):
                word = m[part]
                sort = f"{'surname' if i == len(parts) - 1 else 'given'}_{gender}_{_script(word)}"
                out.append(Found(*m.span(part), sort, word.casefold()))
        elif kind == "email":
            out.append(Found(*m.span("email"), kind, m["email"].lower()))
        elif kind == "secret":
            part = next((x for x in ("quoted", "ticked", "bare", "rest") if m[x]), "secret")
            if part == "bare" and ("." in m[part] or "(" in m[part]) and _CODE.fullmatch(m[part]) and not any(c.isdigit() for c in m[part].partition("(")[0]):
                continue
            out.append(Found(*m.span(part), kind, m[part]))
        elif kind == "ip":
            out.append(Found(*m.span(), kind, surface))
        elif kind == "ipsix":
            out.append(Found(*m.span(), kind, ":".join(f"{x:x}" for x in _groups(surface))))
        else:
            digits = "".join(c for c in surface if c.isalnum())
            if kind == "phone" and surface[0] == "+":
                # The country code stays; its length is what stands before the first separator, or one digit.
                code = re.match(r"\+(\d{1,3})[ .(-]", surface)
                kind = f"phone{len(code[1]) if code else 1}"
            if kind == "card" and luhn(digits):
                kind = "card_checked"
            out.append(Found(m.start(), end, kind, digits))
    out = _one_gender(out)
    surnames = {text[x.start:x.end]: x.kind for x in out if x.kind.startswith("surname_")}
    if surnames:
        taken = [(x.start, x.end) for x in out]
        for m in re.finditer(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, surnames), key=len, reverse=True)) + r")(?!\w)", text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                out.append(Found(*m.span(), surnames[m[0]], m[0].casefold()))
        out.sort()
    return out


def _one_gender(found: list[Found]) -> list[Found]:
    """Where a title tells no gender, that of the same surname elsewhere in the text, if there it has just one."""
    genders: dict[tuple[str, str], set[str]] = {}
    for x in found:
        if x.kind.startswith("surname_"):
            _, gender, script = x.kind.split("_")
            genders.setdefault((x.entity, script), set()).add(gender)
    told = {k: (v - {"n"}).pop() for k, v in genders.items() if len(v - {"n"}) == 1}
    out = list(found)
    for i, x in enumerate(found):
        if x.kind.startswith("surname_n_") and (gender := told.get((x.entity, x.kind[10:]))):
            out[i] = x._replace(kind=f"surname_{gender}_{x.kind[10:]}")
            if i and found[i - 1].kind.startswith("given_n_") and found[i - 1].end + 1 == x.start:
                out[i - 1] = found[i - 1]._replace(kind=f"given_{gender}_{found[i - 1].kind[8:]}")
    return out


def drawn_as(kind: str) -> str:
    """The kind that surrogates are drawn for: a surname is one whoever bears it, its gender only shows elsewhere."""
    return re.sub("^surname_._", "surname_n_", kind)


def _like(entity: str, draw: Iterator[int]) -> str:
    """Letters for letters and digits for digits."""
    return "".join(str(next(draw) % 10) if c.isdigit() else chr((65 if c.isupper() else 97) + next(draw) % 26) if c.isalpha() and c.isascii() else c for c in entity)


def surrogate(key: bytes, kind: str, entity: str, number: int) -> str:
    """The ``number``-th draw for an entity, in its normal form."""

    def stream(about: str) -> Iterator[int]:
        at = 0
        while True:
            # Two bytes for each draw.
            block = hmac.new(key, f"{kind}\0{about}\0{number}\0{at}".encode(), hashlib.sha256).digest()
            yield from (block[i] << 8 | block[i + 1] for i in range(0, 32, 2))
            at += 1

    kind = drawn_as(kind)
    draw = stream(entity)
    if kind == "email":
        local, _, domain = entity.partition("@")
        # Addresses of one domain stay together, unless that is drawn again.
        host, _, top = domain.rpartition(".")
        return f"{_like(local, draw)}@{_like(host, stream('@' + domain))}.{top}"
    if kind == "ip":
        own = 1 if entity.startswith(("10.", "127.")) else 2 if entity.startswith("192.168.") or re.match(r"172\.(1[6-9]|2\d|3[01])\.", entity) else 0
        parts = entity.split(".")
        return ".".join([*parts[:own], *(str(1 + next(draw) % 254) for _ in parts[own:])])
    if kind == "ipsix":
        # Groups of nought stay, so that all spellings fit; the last of each has a decimal digit, which addresses are told by.
        return ":".join("0" if x == "0" else "".join(("123456789" if i in (0, len(x) - 1) else "0123456789abcdef")[next(draw) % (9 if i in (0, len(x) - 1) else 16)] for i in range(len(x))) for x in entity.split(":"))
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", entity):
            digits = "0123456789ABCDEF" if re.search("[A-F]", entity) else "0123456789abcdef"
            return "".join(digits[next(draw) % 16] for _ in entity)
        return _like(entity, draw)
    if kind == "card_checked":
        body = entity[0] + _like(entity[1:-1], draw)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        return entity[:2] + _like(entity[2:], draw)
    if kind.startswith("phone") and kind != "phone":
        code = int(kind[5:])
        return entity[:code] + str(1 + next(draw) % 9) + _like(entity[code + 1:], draw)
    if kind in ("phone", "card", "ssn"):
        # The nought before a number without a country code stays.
        lead = "0" if kind == "phone" and entity[0] == "0" else ""
        drawn = lead + str(1 + next(draw) % 9) + _like(entity[len(lead) + 1:], draw)
        # The kinds with and without a right check digit stay apart.
        return drawn[:-1] + str((int(drawn[-1]) + 1) % 10) if kind == "card" and luhn(drawn) else drawn
    sort, gender, script = kind.split("_")
    syllables, ends = _SYLLABLES[script]
    # Later draws are longer, so there is always room.
    size = 2 + (sort == "surname") + number // 4
    return "".join(syllables[next(draw) % len(syllables)] for _ in range(size)) + (ends["n"] if sort == "surname" else ends[gender])


def written(kind: str, surface: str, drawn: str) -> str:
    """The surrogate in the form of a place in a text."""
    if kind in ("ip", "secret"):
        return drawn
    if kind == "ipsix":
        left, gap, right = surface.partition("::")
        new, ahead, behind = drawn.split(":"), left.split(":"), right.split(":") if gap else []
        texts = [[n.zfill(len(o)) for n, o in zip(new, ahead)], [n.zfill(len(o)) for n, o in zip(new[len(new) - len(behind):], behind)]]
        out = ":".join(texts[0]) + gap + ":".join(texts[1])
        return out.upper() if surface.isupper() else out
    if kind == "email":
        return drawn.upper() if surface.isupper() else "".join(d.upper() if s.isupper() else d for s, d in zip(surface, drawn, strict=True)) if len(surface) == len(drawn) else drawn
    if "_" in kind and kind != "card_checked":
        return drawn.upper() if surface.isupper() and len(surface) > 1 else drawn.capitalize()
    rest = iter(drawn)
    return "".join(next(rest) if c.isalnum() else c for c in surface)


def maybe(text: Column) -> Column:
    """Whether a text may hold an entity; false for null."""
    return F.coalesce(reduce(Column.__or__, (text.rlike(x) if re.search(r"[\[(]", x) else text.contains(x) for x in MAYBE)), F.lit(False))


def entities(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Distinct (``content``, ``kind``, ``entity``); ``content`` is a hash of the text they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(c, drawn_as(x.kind), x.entity): None for c, t in zip(batch.column("content").to_pylist(), batch.column("text"), strict=True) for x in find(t.as_py())}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))], ["content", "kind", "entity"])

    texts = docs.select(F.xxhash64(text_column).alias("content"), F.col(text_column).alias("text")).where(maybe(F.col("text")))
    return texts.mapInArrow(run, "content long, kind string, entity string").distinct()


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(``kind``, ``entity``, ``drawn``) for each distinct (``kind``, ``entity``) of a written table: one to one within a
    kind, and no surrogate is an entity of its kind."""
    spark = found.sparkSession

    def draw(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                rows["drawn"] = [surrogate(key, k, e, number) for k, e in zip(rows["kind"], rows["entity"], strict=True)]
                yield rows

        return run

    real = found.select("kind", "entity").distinct()
    real_path = fresh_path(spark, "entities")
    real.write.parquet(real_path)
    real = open_ = spark.read.parquet(real_path)
    settled = None
    for number in range(MAX_DRAWS):
        path = fresh_path(spark, "draws")
        tried = open_.select("kind", "entity").mapInPandas(draw(number), "kind string, entity string, drawn string")
        tried = tried.join(real.select("kind", F.col("entity").alias("drawn"), F.lit(True).alias("is_real")), ["kind", "drawn"], "left")
        if settled is not None:
            tried = tried.join(settled.select("kind", "drawn", F.lit(True).alias("is_taken")), ["kind", "drawn"], "left")
        else:
            tried = tried.withColumn("is_taken", F.lit(None).cast("boolean"))
        first = tried.where("is_real is null and is_taken is null").groupBy("kind", "drawn").agg(F.min("entity").alias("entity"))
        rows = open_.select("kind", "entity").join(first, ["kind", "entity"], "left")
        rows.write.parquet(path)
        done = spark.read.parquet(path)
        kept = done.where("drawn is not null").select("kind", "entity", "drawn")
        settled = kept if settled is None else settled.unionByName(kept)
        open_ = done.where("drawn is null")
        if open_.isEmpty():
            return settled
    raise ValueError("a kind has more entities than its format has surrogates")


def replace(docs: DataFrame, key: bytes, text_column: str = "text", count_column: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with surrogates in the text; ``count_column`` adds the number of places."""
    spark = docs.sparkSession
    path = fresh_path(spark, "found")
    entities(docs, text_column).write.parquet(path)
    found = spark.read.parquet(path)
    drawn = found.join(assign(found, key), ["kind", "entity"])
    # One row for each distinct text: what it holds is bounded by the text.
    maps = drawn.groupBy("content").agg(F.collect_list(F.struct("kind", "entity", "drawn")).alias("drawn"))

    def write(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, many in batches:
            out = []
            for text, pairs in zip(texts, many, strict=True):
                known = {(x["kind"], x["entity"]): x["drawn"] for x in (pairs if pairs is not None else ())}
                parts, at, places = [], 0, find(text) if known else []
                for x in places:
                    parts += [text[at:x.start], written(x.kind, text[x.start:x.end], known[drawn_as(x.kind), x.entity])]
                    at = x.end
                out.append(("".join([*parts, text[at:]]) if places else text, len(places)))
            yield pd.DataFrame(out, columns=["text", "places"])

    udf = F.pandas_udf(write, "text string, places int")
    inner = "`content" + "_".join(docs.columns).replace("`", "") + "`"
    made = inner[:-1] + "_made`"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    source = F.col(f"`{text_column}`")
    joined = docs.where(maybe(source)).withColumn(inner.strip("`"), F.xxhash64(source)).join(maps.withColumnRenamed("content", inner.strip("`")).withColumnRenamed("drawn", made.strip("`") + "_map"), inner.strip("`"), "left")
    joined = joined.withColumn(made.strip("`"), udf(source, F.col(made[:-1] + "_map`")))
    changed = joined.select(*(F.col(f"{made}.text").alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns), *([F.col(f"{made}.places").alias(count_column)] if count_column else []))
    rest = docs.where(~maybe(source)).select(*columns, *([F.lit(0).alias(count_column)] if count_column else []))
    return changed.unionByName(rest)
