"""Personal data replaced by keyed surrogates of the same kind and format.

Detected are e-mail addresses, IP addresses, payment card numbers, bank accounts
(IBAN), social security numbers, phone numbers, and names behind a form of
address. An entity is its kind and canonical value: digits without separators,
addresses in lower case. Its surrogate comes from a keyed hash of both, so the same
entity has the same surrogate wherever and however it is written; separators,
lengths, letter case, script, gender and check digits stay as they were.

Surrogates are checked over the whole corpus: two entities never share one, and
none equals a value that occurs in the corpus. Where that fails, all but the least
entity are drawn again. Without the key the surrogates can't be told or undone.

Null texts stay null; texts without finds and all other columns stay as they are.
Overlapping finds go to the kind listed first. Equal rows stay and get equal texts.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import fresh
from ferrylog.session import written

#: For tests and examples; a deployment passes its own secret.
DEMO_KEY = "replace-this-key"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\w'’-]+"
KINDS = {
    "email": re.compile(r"(?<![\w.+%-])[\w.+%-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ip": re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)"),
    "card": re.compile(r"(?<![\w-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w.-])\d{13,19}(?![\w-]|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
        r"|(?<![\w.])\+\d{1,3}(?:[ .-]?\d)?(?:[ .-]?\d{2,4}){2,5}(?!\w)"
        r"|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])"
    ),
    "name": re.compile(
        rf"\b(?:(?P<m>Mr|Herr|Señor|Sr|Monsieur|г-н)|(?P<f>Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|г-жа)"
        rf"|(?P<n>Dr|Prof))\.? (?P<who>{_CAPITAL}(?: {_CAPITAL}){{0,2}})"
    ),
}
#: A digit of any script; what the JVM's Unicode does not know yet may be one, too.
_DIGIT = r"[\p{Nd}\p{Cn}]"
#: A text without any of these holds no entity: each is a part that every match of a kind has.
MAY_HOLD = (
    rf"@|{_DIGIT}{{3}}|{_DIGIT}\.{_DIGIT}|\({_DIGIT}{{2,4}}\)|\+{_DIGIT}|[A-Z]{{2}}{_DIGIT}{{2}}"
    r"|(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Se.or|Se.ora|Sr|Sra|Monsieur|Madame|Mme|г-н|г-жа)\.? "
)

#: Given names by script and gender.
GIVEN = {
    ("latin", "m"): "James Peter Thomas Martin Paul Daniel Robert Lucas Henry Oscar Felix Simon Victor Hugo Leon Adam".split(),
    ("latin", "f"): "Mary Anna Laura Emma Julia Sarah Clara Alice Nora Helen Maria Eva Lucy Rosa Irene Diana".split(),
    ("cyrillic", "m"): "Иван Пётр Павел Олег Игорь Антон Юрий Роман".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Ирина Нина Вера Юлия".split(),
}
LETTERS = {
    "latin": ("aeiou", "bcdfghklmnprstvz"),
    "greek": ("αεηιου", "βγδζθκλμνπρστφχ"),
    "cyrillic": ("аеиоуя", "бвгдзклмнпрст"),
}


def script_of(char: str) -> str:
    name = unicodedata.name(char, "")
    return next((s for s in ("greek", "cyrillic") if name.startswith(s.upper())), "latin")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _ascii(raw: str) -> str:
    """The text with the digits of all scripts as 0 to 9."""
    return raw if raw.isascii() else "".join(str(int(c)) if c.isdecimal() else c for c in raw)


def canonical(kind: str, raw: str) -> str:
    if kind in ("card", "ssn", "phone", "iban", "ip"):
        raw = _ascii(raw)
    if kind in ("card", "ssn", "phone"):
        return ("+" if raw.startswith("+") else "") + re.sub(r"\D", "", raw)
    if kind == "iban":
        return raw.replace(" ", "")
    return raw.lower() if kind == "email" else raw


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) from left to right, without overlaps."""
    # without overlaps, so the neighbours by start tell whether a span is free
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in KINDS.items():
        for m in pattern.finditer(text):
            a, b = m.span("who") if kind == "name" else m.span()
            value = canonical(kind, text[a:b])
            if kind == "iban" and not iban_ok(value):
                continue
            if kind == "name":
                gender = next(g for g in "mfn" if m[g])
                value = f"{gender}:{value}"
            at = bisect_left(found, (a,))
            if (at == 0 or found[at - 1][1] <= a) and (at == len(found) or b <= found[at][0]):
                found.insert(at, (a, b, kind, value))
    return found


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: str, *parts: object) -> None:
        self.seed = "\x1f".join(map(str, parts)).encode()
        self.key = hashlib.blake2b(key.encode()).digest()
        self.block, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            part = self.seed + self.block.to_bytes(8, "big")
            self.left = hashlib.blake2b(part, key=self.key).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n


def _letters(word: str, draw: Draw) -> str:
    """Vowels for vowels, consonants for consonants, in the script and case of the word."""
    out = []
    for c in word:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            base = unicodedata.normalize("NFD", c)[0].lower()
            vowels, others = LETTERS[script_of(c)]
            pool = vowels if base in vowels else others
            new = pool[draw.below(len(pool))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    """The canonical surrogate of an entity; later attempts differ, and grow at last."""
    draw = Draw(key, kind, value, attempt)
    longer = "x" * (attempt // 8)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        names = Draw(key, "domain", domain)
        host = ".".join([*(_letters(x, names) for x in labels[:-1]), labels[-1]])
        return f"{_letters(local + longer, draw)}@{host}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "name":
        gender, _, who = value.partition(":")
        parts, out = who.split(" "), []
        for k, part in enumerate(parts):
            script = script_of(part[0])
            pools = [g for g in ("m", "f") if part in GIVEN.get((script, g), ())]
            own = gender if gender in "mf" else (pools[0] if pools else "")
            if k == 0 and len(parts) > 1 and (script, own) in GIVEN:
                pool = GIVEN[script, own]
                out.append(pool[draw.below(len(pool))])
            else:
                out.append(_letters(part + (longer if k == len(parts) - 1 else ""), draw))
        return f"{gender}:{' '.join(out)}"
    if kind == "iban":
        body = _letters(value[4:], draw).upper()
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    plus, digits = ("+", value[1:]) if value.startswith("+") else ("", value)
    kept = 1 if kind == "phone" and plus else 0
    new = digits[:kept] + "".join(str(draw.below(10)) for _ in digits[kept:])
    if kind == "card" and luhn(digits):
        new = next(n for d in "0123456789" if luhn(n := new[:-1] + d))
    return plus + new


def _like(old: str, new: str) -> str:
    """A digit in the script of the one it replaces."""
    if old.isascii() or not (old.isdecimal() and new.isdecimal()):
        return new
    return chr(ord(old) - int(old) + int(new))


def render(kind: str, raw: str, value: str) -> str:
    """A canonical surrogate written the way the original was."""
    if kind in ("card", "ssn", "phone", "iban"):
        chars = iter(value.removeprefix("+"))
        return "".join(_like(c, next(chars, "")) if c.isalnum() else c for c in raw) + "".join(chars)
    if kind == "name":
        return value.partition(":")[2]
    if kind == "email" and raw != raw.lower() and len(raw) == len(value):
        return "".join(v.upper() if c.isupper() else v for c, v in zip(raw, value, strict=True))
    return value


FOUND = "array<struct<start:int,end:int,kind:string,value:string>>"


def _detected(docs: DataFrame, text: str, out: str) -> DataFrame:
    @F.pandas_udf(FOUND)
    def detect(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(
                [
                    [dict(zip(("start", "end", "kind", "value"), e, strict=True)) for e in entities(t)]
                    for t in part
                ]
            )

    return docs.withColumn(out, detect(F.col(text)))


def assigned(found: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for the distinct entities (kind, value), free of collisions."""

    @F.pandas_udf("string")
    def drawn(kinds: pd.Series, values: pd.Series, attempts: pd.Series) -> pd.Series:
        rows = zip(kinds, values, attempts, strict=True)
        return pd.Series([surrogate(key, k, v, int(n)) for k, v, n in rows], dtype=object)

    real = written(found.select("kind", "value").distinct(), "entities")
    open_, done, attempt = real, None, 0
    while True:
        tried = written(
            open_.withColumn("surrogate", drawn("kind", "value", F.lit(attempt))), "drawn"
        )
        taken = real.select("kind", F.col("value").alias("surrogate"))
        if done is not None:
            taken = taken.union(done.select("kind", "surrogate"))
        first = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "value", "surrogate")
        good = written(good if done is None else good.union(done), "assigned")
        left = written(real.join(good, ["kind", "value"], "left_anti"), "open")
        if left.isEmpty():
            return good
        open_, done, attempt = left, good, attempt + 1


def replaced(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and the number of replacements."""
    ents, dk, dk2, spans = fresh(docs, "_ents", "_dk", "_dk2", "_spans")
    may = F.coalesce(F.col(text).rlike(MAY_HOLD), F.lit(False))
    plain = docs.filter(~may).withColumn(count, F.lit(0).cast("long"))
    some = docs.filter(may).withColumn(dk, F.unhex(F.md5(F.col(text))))
    every = _detected(some.select(F.col(dk).alias("dk"), F.col(text).alias("text")), "text", "ents")
    flat = every.select("dk", F.explode("ents").alias("e")).select("dk", "e.*").distinct()
    flat = written(flat, "occurrences")
    mapping = assigned(flat, key)
    listed = (
        flat.join(mapping, ["kind", "value"])
        .groupBy("dk")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias(spans))
        .withColumnRenamed("dk", dk2)
    )

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, finds: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(texts, finds, strict=True):
            parts, at = [], 0
            for e in () if found is None else found:
                parts += [t[at : e["start"]], render(e["kind"], t[e["start"] : e["end"]], e["surrogate"])]
                at = e["end"]
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    changed = some.join(listed, F.col(dk) == F.col(dk2), "left")
    changed = changed.withColumn(text, rewrite(F.col(text), F.col(spans))).withColumn(
        count, F.coalesce(F.size(spans), F.lit(0)).cast("long")
    )
    changed = changed.withColumn(count, F.greatest(F.col(count), F.lit(0)))
    return changed.select(*docs.columns, count).union(plain.select(*docs.columns, count))


def private_texts(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """doc_id, the text with surrogates, and how many there are."""
    return replaced(docs.select("doc_id", "text"), key)
