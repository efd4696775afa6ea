"""PII: detected entities replaced by keyed surrogates.

Detection gives spans with a kind and a value (e-mail, IPv4, card, phone, IBAN,
social security number, secret, given name with gender, surname). A surrogate is a
keyed function of kind, value and attempt that keeps the format: digits stay
digits, letters keep case and script, separators, country codes, key prefixes and
top-level domains stay, a valid card number stays valid, a given name keeps its
gender. The same value gets the same surrogate wherever it stands (coreference).

A name follows an honorific: up to MOST_NAMES words with initials and particles among
them. The last word, and any after a particle, is a surname, the others given names;
particles stay. Every other mention of such a word in the same text is the same entity.
An initial becomes another letter by a keyed cycle of its alphabet: 26 letters leave no
room for distinctness from the corpus.

Distinctness is checked over the whole corpus: the distinct values (combined
before the shuffle) get surrogates; a surrogate that equals some value of the corpus
or the surrogate of a lesser value is drawn again with the next attempt, until none
is left; every WIDER attempts the format is widened, so that this ends. Documents that may hold an entity are joined with their own values; all
others pass without a shuffle.

Defined cases: null text stays null and has no entities; repeated rows are replaced
alike; a text of any length is read whole; an empty table gives no rows; columns
besides ``doc_id`` and ``text`` pass unchanged (``n_chars`` is brought up to date in
``replace_all``).
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import materialise, plainly_named, ship_package

KEY = "surrogates-1"  # of tests and the registered queries, unless the session names another
WIDER = 4  # attempts after which a format is widened once more
COUNTED = ("email", "ip", "card", "phone", "iban", "ssn", "secret", "given", "surname")

# Honorifics by gender, and given names by gender and script.
HONORIFICS = {
    "m": "Mr Herr Monsieur Señor Sr господин г-н".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra госпожа г-жа".split(),
}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Louis Martin Noel Oscar Paul Rafael Simon Thomas Victor".split(),
    ("f", "latin"): "Alice Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Marie Nadia Olivia Paula Rosa Sofia Teresa Vera".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Леонид Максим Никита Олег Павел Роман".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Раиса".split(),
}
SYLLABLES = {"latin": "ba be bi bo da de di do ka ke ko la le li lo ma me mi mo na ne no ra re ri ro sa se so ta te to va ve vo".split(),
             "cyrillic": "ба бе бо ва ве да де до за ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то".split()}

MOST_NAMES = 6
PARTICLES = "al bin da das de del della den der di do dos du el ibn la le ter ten van von vom zu zum zur".split()
# Words that open a sentence or clause; a name ends before them.
NO_NAMES = ("The This That These Those He She It They We You His Her Their And But Or If When Then There In On At As For To From With "
            "Ce Cette Il Elle Ils Elles Et Mais Ou Dans Pour Avec Er Sie Es Wir Und Aber Oder Im Am Mit Ein Eine Das "
            "Ella Ellos En Pero Con Por Para Un Una Est Ist Is Was Has Had Said").split()
_UPPER = r"[^\W\d_a-zß-öø-ÿа-яё]"
_NAME = rf"(?:{_UPPER}['’])?{_UPPER}[^\W\d_]+(?:-[^\W\d_]+)*"
_INITIAL = rf"{_UPPER}(?:\.(?:-?{_UPPER}\.)*[ \xa0]?|[ \xa0])"
_LEAD = rf"(?:{_INITIAL}|(?:{'|'.join(x for p in PARTICLES for x in (p, p.capitalize()))})[ \xa0])*"
_NO_NAME = rf"(?!(?:{'|'.join([*NO_NAMES, *HONORIFICS['m'], *HONORIFICS['f']])})(?!\w))"
_PART = re.compile(rf"(?P<name>{_NAME})|(?P<initial>(?<!\w){_UPPER}(?!\w))|(?P<particle>[^\W\d_]+)")
_PARTICLES = {x for p in PARTICLES for x in (p, p.capitalize())}
_MENTION = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_NEVER = {*NO_NAMES, *HONORIFICS["m"], *HONORIFICS["f"], *_PARTICLES}
_PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-]))"
    r"|(?P<aws>(?<![A-Za-z0-9])(?:AKIA|akia)[A-Za-z0-9]{16}(?![A-Za-z0-9]))"
    r"|(?P<keyed>(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api_?key)\s?[=:]\s?[\"']?(?P<secret>[A-Za-z0-9_\-]{8,})(?![A-Za-z0-9_\-]))"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<abroad>(?<![\w+])00[1-9](?=\d{0,2}[ .\-/(])(?:[ .\-/]?\(?\d\)?){6,14}(?!\w))"
    r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w))"
    r"|(?P<plus>(?<![\w+])\+\d(?:[ .\-/]?\(?\d\)?){6,14}(?!\w))"
    r"|(?P<title>(?<!\w)(?:" + "|".join(HONORIFICS["m"] + HONORIFICS["f"]) + r")\.?[ \xa0])(?P<names>" + _LEAD + _NAME
    + r"(?:[ \xa0]" + _LEAD + _NO_NAME + _NAME + r"){0," + str(MOST_NAMES - 1) + "})"
)
_GENDER = {h: g for g, own in HONORIFICS.items() for h in own}
# What a text must hold to have any entity, for a cheap test before the full pattern.
_HINTS = ("=", ":", "AKIA", "akia", "Mr", "Ms", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Sr", "господин", "г-н", "госпожа", "г-жа")


def hinted(text: Column) -> Column:
    found = text.rlike("[0-9@]")
    for hint in _HINTS:
        found = found | F.contains(text, F.lit(hint))
    return F.coalesce(found, F.lit(False))


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of every entity, in order, without overlaps."""
    out = []
    for m in _PATTERN.finditer(text):
        if m["email"]:
            out.append((m.start(), m.end(), "email", m["email"]))
        elif m["aws"]:
            out.append((m.start() + 4, m.end(), "secret", m["aws"][4:]))
        elif m["keyed"]:
            out.append((*m.span("secret"), "secret", m["secret"]))
        elif m["ip"]:
            if all(int(x) < 256 for x in m["ip"].split(".")):
                out.append((m.start(), m.end(), "ip", m["ip"]))
        elif m["card"]:
            digits = "".join(c for c in m["card"] if c.isdigit())
            if _luhn(digits[:-1]) == int(digits[-1]):  # other long numbers are no cards
                out.append((m.start(), m.end(), "card", m["card"]))
        elif m["title"]:
            out += _names(text, *m.span("names"), _GENDER[m["title"].rstrip(" .\xa0")])
        elif m["abroad"] or m["plus"]:
            out.append((m.start(), m.end(), "phone", m[0]))
        else:
            kind = m.lastgroup
            out.append((m.start(), m.end(), kind, m[kind]))
    return _with_mentions(text, out)


def _names(text: str, start: int, end: int, gender: str) -> list[tuple[int, int, str, str]]:
    """Entities of the name that follows an honorific."""
    parts = list(_PART.finditer(text, start, end))
    words = [k for k, p in enumerate(parts) if p["name"] and (p[0] not in _PARTICLES or k == len(parts) - 1)]
    out, family = [], False
    for k, p in enumerate(parts):
        if p["initial"]:
            out.append((*p.span(), "given_initial", p[0]))
        elif k in words:
            kind = "surname" if family or k == words[-1] else f"given_{gender}"
            out.append((*p.span(), kind, p[0]))
        else:
            family = True
    return out


def _with_mentions(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """``found`` with every other mention of its names, in order."""
    names: dict[str, str] = {}
    for _, _, kind, value in found:
        if kind in ("given_m", "given_f", "surname") and value not in _NEVER:
            names.setdefault(value, kind)
    if not names:
        return found
    more = []
    for m in _MENTION.finditer(text):
        if m[0] in names:
            more.append((*m.span(), names[m[0]], m[0]))
        elif "-" in m[0]:
            at = m.start()
            for part in m[0].split("-"):
                if part in names:
                    more.append((at, at + len(part), names[part], part))
                at += len(part) + 1
    out, k = [], 0
    for x in more:  # both in order; what lies in a found entity belongs to it
        while k < len(found) and found[k][1] <= x[0]:
            out.append(found[k])
            k += 1
        if k == len(found) or x[1] <= found[k][0]:
            out.append(x)
    return out + found[k:]


class _Draw:
    """Keyed numbers for one value and attempt."""

    def __init__(self, key: str, kind: str, value: str, attempt: int):
        self._seed = f"{kind}\0{attempt}\0{value}".encode("utf-8", "surrogatepass")
        self._key, self._count, self._left = key.encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self._left) < 4:
            self._left = hmac.new(self._key, self._seed + self._count.to_bytes(4, "big"), hashlib.sha256).digest()
            self._count += 1
        own, self._left = int.from_bytes(self._left[:4], "big"), self._left[4:]
        return own % n

    def like(self, c: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            new = letters[self.below(len(letters))]
            return new.upper() if c.isupper() else new
        return c


def _luhn(digits: str) -> int:
    """Check digit that makes ``digits`` + it valid."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


_CYCLES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")


def _next_initial(letter: str, key: str) -> str:
    """The letter after ``letter`` in a keyed order of its alphabet."""
    own = next((c for c in _CYCLES if letter in c), _CYCLES[0] + letter)
    order = sorted(own, key=lambda c: hmac.new(key.encode(), f"initial\0{c}".encode(), hashlib.sha256).digest())
    return order[(order.index(letter) + 1) % len(order)]


def _case_like(new: str, old: str) -> str:
    return new.upper() if old.isupper() and len(old) > 1 else new


def surrogate(kind: str, value: str, attempt: int = 0, key: str = KEY) -> str:
    """Replacement of the same kind and format; from attempt WIDER on the format is
    widened by one more character every WIDER attempts, so no pool runs out."""
    draw = _Draw(key, kind, value, attempt)
    wider = attempt // WIDER

    def more(letters: str = "0123456789") -> str:
        return "".join(letters[draw.below(len(letters))] for _ in range(wider))

    if kind == "given_initial":
        return _next_initial(value, key)
    if kind == "ip":
        own = [(1, 9), (10, 99), (100, 254)]  # beyond: numbers that no address holds
        size = [len(x) + wider for x in value.split(".")]
        ranges = [own[n - 1] if n <= 3 else (256, 999) if n == 4 else (10 ** (n - 2), 10 ** (n - 1) - 1) for n in size]
        return ".".join(str(lo + draw.below(hi - lo + 1)) for lo, hi in ranges)
    if kind == "card":
        digits = [c for c in value if c.isdigit()]
        new = digits[:1] + [str(draw.below(10)) for _ in digits[1:]]
        new[-1] = str(_luhn("".join(new[:-1])))
        fill = iter(new)
        return "".join(next(fill) if c.isdigit() else c for c in value) + more()
    if kind == "phone":
        cut = re.match(r"(?:\+|00)\d{1,3}(?=[ ./(-])", value)
        head = cut[0] if cut else ""
        body = "".join(str(2 + draw.below(8)) if c.isdigit() and (k == 0 or not p.isdigit()) else draw.like(c)
                       for k, (p, c) in enumerate(zip(" " + value[len(head):], value[len(head):])))
        return head + body + more()
    if kind == "email":
        local, _, domain = value.rpartition("@")
        name, _, top = domain.rpartition(".")
        return "".join(map(draw.like, local)) + more("abcdefghijklmnopqrstuvwxyz") + "@" + "".join(map(draw.like, name)) + "." + top
    if kind == "secret":
        hexa = re.fullmatch(r"[0-9a-fA-F]+", value) is not None
        pick = "0123456789abcdef" if hexa else "abcdefghijklmnopqrstuvwxyz0123456789"
        upper = value.upper() == value
        return "".join((x.upper() if upper else x) if c.isalnum() else c for c in value for x in (pick[draw.below(len(pick))],)) + more(
            pick.upper() if upper else pick)
    if kind == "iban":
        return value[:2] + "".join(map(draw.like, value[2:])) + more()
    if kind == "ssn":
        return "".join(map(draw.like, value)) + more()
    script = "cyrillic" if re.search("[Ѐ-ӿ]", value) else "latin"
    if kind.startswith("given"):
        own = GIVEN[kind[-1], script]
        name = own[draw.below(len(own))]
        if attempt:  # the list is short: a second name keeps gender and tells values apart
            name += "-" + own[draw.below(len(own))] + "".join(SYLLABLES[script][draw.below(30)] for _ in range(attempt // 8))
        return _case_like(name, value)
    parts = 2 + draw.below(2) + attempt // 4
    return _case_like("".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(parts)).capitalize(), value)


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``spark.stratum.surrogateKey``."""
    return spark.conf.get("spark.stratum.surrogateKey", KEY)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [(k, kind, value) for k, t in zip(f["tid"], f["text"]) for kind, value in {(x[2], x[3]) for x in find(t)}
                if kind != "given_initial"]
        yield pd.DataFrame(rows, columns=["tid", "kind", "value"])


def _drawn(key: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f[["kind", "value", "attempt"]].copy()
            f["surrogate"] = [surrogate(*x, key) for x in zip(f["kind"], f["value"], f["attempt"])]
            yield f

    return run


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate: distinct surrogates, none of which is a value itself."""
    schema = "kind string, value string, attempt int, surrogate string"
    own = materialise(values.select("kind", "value").distinct(), "pii-values")
    taken = own.select(F.col("value").alias("taken")).distinct()
    now = materialise(own.withColumn("attempt", F.lit(0)).mapInPandas(_drawn(key), schema), "pii-drawn")
    # earlier attempts keep what they have, so that a redraw never unsettles a settled value
    mine = F.struct("attempt", "kind", "value")
    while True:  # ends: pools grow with the attempts, and settled values stay
        # one row a surrogate, elected before the shuffle: many names may share a surrogate
        first = now.groupBy("surrogate").agg(F.min(mine).alias("first"))
        ranked = now.join(first, "surrogate").join(taken, F.col("surrogate") == F.col("taken"), "left")
        judged = ranked.select("kind", "value", "attempt", "surrogate", ((mine != F.col("first")) | F.col("taken").isNotNull()).alias("clash"))
        judged = materialise(judged, "pii-judged")
        if judged.where("clash").isEmpty():
            return judged.select("kind", "value", "surrogate")
        again = judged.where("clash").withColumn("attempt", F.col("attempt") + 1).mapInPandas(_drawn(key), schema)
        now = materialise(judged.where("not clash").drop("clash").unionAll(again), "pii-drawn")


def _replaced(columns: list[str], key: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts, counts = [], {k: [] for k in COUNTED}
            for text, pairs in zip(f["text"], f["__map"]):
                new = {(p["kind"], p["value"]): p["surrogate"] for p in pairs}
                out, at, own = [], 0, dict.fromkeys(COUNTED, 0)
                for start, end, kind, value in find(text):
                    out += [text[at:start], _next_initial(value, key) if kind == "given_initial" else new[kind, value]]
                    at, own[kind.split("_")[0]] = end, own[kind.split("_")[0]] + 1
                texts.append("".join(out) + text[at:])
                for k, n in own.items():
                    counts[k].append(n)
            done = f[columns].copy()
            done["text"] = texts
            for k in COUNTED:
                done[f"__{k}"] = counts[k]
            yield done

    return run


def replaced(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with replaced texts, all columns as they were, whatever their names
    (``n_chars`` counted anew where it is there)."""
    own = plainly_named(documents, ("doc_id", "text", "n_chars"))
    return replace_all(own, key).select(*own.columns).toDF(*documents.columns)


def replace_all(documents: DataFrame, key: str) -> DataFrame:
    """As ``replaced``, with ``__<kind>`` counts: names that ``documents`` must not have.
    Who holds ``key`` can draw the surrogates again: it is the caller's to choose and keep."""
    ship_package(documents.sparkSession)
    columns = documents.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    counts = ", ".join(f"`__{k}` int" for k in COUNTED)
    may = hinted(F.col("text"))
    found = materialise(documents.where(may).select(_text_key(F.col("text")).alias("tid"), "text").mapInPandas(
        _found, "tid binary, kind string, value string"), "pii-found")
    table = surrogate_table(found, key)
    pairs = found.distinct().join(table, ["kind", "value"])
    maps = materialise(pairs.groupBy("tid").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("__map")), "pii-maps")
    held = maps.withColumnRenamed("tid", "__tid")
    with_map = documents.where(may).join(held, _text_key(F.col("text")) == F.col("__tid"), "left").select(
        *columns, F.coalesce("__map", F.expr("cast(array() as array<struct<kind:string,value:string,surrogate:string>>)")).alias("__map"))
    changed = with_map.mapInPandas(_replaced(columns, key), f"{fields}, {counts}")
    plain = documents.where(~may).select(*columns, *[F.lit(0).alias(f"__{k}") for k in COUNTED])
    out = changed.unionAll(plain)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(
            documents.schema["n_chars"].dataType))
    return out
