"""Surrogates for personal data: keyed, of the same type and form, distinct for distinct entities, the same for the same one.

An entity has a canonical form (an address in lower case, a number's digits, a name's part in lower case): mentions that share
it co-refer, however they are written and whatever title they have. Its surrogate is drawn from a keyed hash, character by
character of the same kind; a name's is made of syllables of its script with an ending of its gender, which the titles in the
whole corpus tell. All distinct entities of the corpus are checked together: a surrogate that two entities draw, or that is
itself an entity of the corpus, is drawn again by all but one. A mention's surrogate takes over its writing: separators,
brackets, capitals. Names are found by a title; a part found so is also replaced where it stands without title in its text.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import os
import re
import secrets
import string
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import Scratch, fresh, release

#: Titles by the gender they tell; fixed list.
TITLES = {"m": "Mr|Herr|Herrn|Monsieur|Señor|Sr|Don|г-н|господин|κύριος", "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Srta|Doña|г-жа|госпожа|κυρία", "n": "Dr|Prof|Mx"}
#: The same in capitals.
TITLES = {g: "|".join(dict.fromkeys(x for t in ts.split("|") for x in (t, t.upper()))) for g, ts in TITLES.items()}
#: Syllables by script, and endings by gender.
SYLLABLES = {"LATIN": "ba be bo da de do fa fe ga go ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi".split(), "CYRILLIC": "ба бо ва ве да де до ка ко ла ле ли ма ме ми на не ни но па ра ре ро са се со та те ти то".split(), "GREEK": "βα γα δα δε θα κα κο λα λε λι μα με μι να νε νι πα ρα ρε ρο σα σε τα τε τι".split()}
ENDINGS = {("LATIN", "m"): ["n", "r", "s"], ("LATIN", "f"): ["na", "la", "ra"], ("CYRILLIC", "m"): ["н", "р", "в"], ("CYRILLIC", "f"): ["на", "ла", "ва"], ("GREEK", "m"): ["ς"], ("GREEK", "f"): ["α", "η"]}
#: Entities that may be broadcast, at most: those with more than 1/HOT of all mentions.
HOT = 4_096
#: What a text must hold for an entity to be in it; for Spark.
_FIRST = "".join(sorted({t[0] for ts in TITLES.values() for t in ts.split("|")}))
#: The class in front keeps a matcher from trying all titles at every character.
TRIGGER = r"[@\p{Nd}]|:[0-9a-fA-F]{1,4}:|(?=[A" + _FIRST + r"])(?:A[KS]IA[A-Z]|(?:" + "|".join(TITLES.values()) + r")[. ])"

#: A name's part: an initial with an apostrophe stays, what follows is the part; hyphens join parts.
_WORD = r"(?:[^\W\d_]['’])?[^\W\d_]{2,}"
_NAME = _WORD + r"(?:-" + _WORD + r")*"
_PATTERNS = (
    ("email", r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)+"),
    ("aws", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"),
    ("hex", r"\b(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,64}\b"),
    ("ipv6", r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])|(?<![\w:])(?=[0-9a-fA-F:]*\d)(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6}(?![\w:])"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("card", r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d])(?!\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ip", r"(?<![\d.])(?<![vV])(?<![vV]ersion )(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d(?:[ .()/-]{0,2}\d){7,14}(?!\d)"),
)
_NUMERIC = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS))
_NAMED = re.compile("(?=[" + _FIRST + r"])\b(?P<title>" + "|".join(TITLES.values()) + r")(?:\. ?| )(?P<who>" + _NAME + r"(?: " + _NAME + r"){0,2})")
_PART = re.compile(r"(?:(?<![\w'’])[^\W\d_]['’])?(?P<part>[^\W\d_]{2,})")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts.split("|")}
_RARE = re.compile(r"[@\d]|:[0-9a-fA-F]{1,4}:")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def canonical(kind: str, mention: str) -> str | None:
    """What co-referring mentions share; null if it is none of its kind after all."""
    if kind in ("card", "phone", "ssn"):
        digits = re.sub(r"\D", "", mention)
        if kind == "card" and not (luhn(digits) or (len(digits) in (15, 16) and digits[0] in "3456")):
            return None
        return digits
    if kind == "ip":
        return mention if all(int(x) < 256 for x in mention.split(".")) else None
    if kind == "iban":
        return mention.replace(" ", "")
    return mention if kind == "aws" else mention.lower()


def iban_check(iban: str) -> int:
    """What an IBAN leaves by 97; 1 if its check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _script(word: str) -> str:
    """The first word of the first letter's name: LATIN, CJK, HANGUL and so on."""
    return unicodedata.name(word[0], "LATIN").split()[0]


@functools.lru_cache(4096)
def _letters(letter: str) -> str:
    """Letters of the same script and kind near a letter of a script without syllables."""
    at, kind, script = ord(letter) & ~0xFF, unicodedata.category(letter), _script(letter)
    return "".join(c for c in map(chr, range(at, at + 256)) if unicodedata.category(c) == kind and _script(c) == script)


def _named(part: str) -> bool:
    """Whether a word may be part of a name: a capital first, or a script without capitals."""
    return part[0] == part[0].upper()


def find(text: str) -> list[tuple[int, int, str, str, str]]:
    """Start, end, kind, canonical form and gender (m, f or n) of the entities of a text, in order, none within another.

    A name's kind holds its script: name:LATIN. Its parts are entities of their own, so that a first name or a family name
    stays the same wherever it stands; a title tells the gender of the first part only if others follow it.
    """
    out = []
    if _RARE.search(text) or "AKIA" in text or "ASIA" in text:
        for m in _NUMERIC.finditer(text):
            if (c := canonical(m.lastgroup, m.group())) is not None:
                out.append((m.start(), m.end(), m.lastgroup, c, "n"))
    taken = [(a, b) for a, b, *_ in out]
    names, parts = [], set()
    for m in _NAMED.finditer(text):
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        words = []
        for w in re.finditer(_NAME, m.group("who")):
            if not _named(w.group()):
                break
            words.append([(m.start("who") + w.start() + x.start("part"), m.start("who") + w.start() + x.end("part")) for x in _PART.finditer(w.group())])
        for k, spans in enumerate(words):
            gender = _GENDER[m.group("title")] if len(words) == 1 or k == 0 else "n"
            for a, b in spans:
                names.append((a, b, gender))
                parts.add(text[a:b].lower())
    if parts:
        own = {a for a, _, _ in names}
        titled = set(_GENDER)
        for m in _PART.finditer(text):
            a, b = m.span("part")
            if a not in own and text[a:b].lower() in parts and _named(text[a:b]) and text[a:b] not in titled and not any(x < b and a < y for x, y in taken):
                names.append((a, b, "n"))
    out += [(a, b, f"name:{_script(text[a:b])}", text[a:b].lower(), g) for a, b, g in names]
    return sorted(out)


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    k = 0
    while True:
        for b in hmac.new(key, "\0".join([*parts, str(k)]).encode(), hashlib.sha256).digest():
            yield b
        k += 1


def _pick(s: Iterator[int], options: str | list[str]) -> str:
    n = next(s) << 16 | next(s) << 8 | next(s)
    return options[n % len(options)]


def _like(s: Iterator[int], text: str) -> str:
    """Letters for letters, of the same case and, in the alphabets known, script; digits for digits; the rest as it is."""
    out = []
    for c in text:
        if c.isdigit() and c.isascii():
            out.append(_pick(s, string.digits))
        elif c.isalpha():
            script = _script(c)
            letters = string.ascii_lowercase if script == "LATIN" else sorted({x for w in SYLLABLES[script] for x in w}) if script in SYLLABLES else _letters(c)
            x = _pick(s, letters)
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, canon: str, attempt: int = 0, gender: str = "n") -> str:
    """The canonical form of an entity's surrogate at an attempt; of the same length, names apart.

    Later attempts widen a form that runs short: names and addresses grow longer, numbers of hosts take any digits.
    """
    s = _stream(key, kind, canon, str(attempt))
    if kind.startswith("name"):
        script = kind.split(":")[1]
        if script not in SYLLABLES:
            return _like(s, canon + canon[-1:] * (attempt // 8))
        ends = ENDINGS.get((script, gender)) or ENDINGS[script, "m"] + ENDINGS[script, "f"]
        n = min(max(1, len(canon) // 2 - 1) + attempt // 4, 12)
        return "".join(_pick(s, SYLLABLES[script]) for _ in range(n)) + _pick(s, ends)
    if kind == "email":
        local, _, domain = canon.partition("@")
        host, _, tld = domain.rpartition(".")
        if attempt < 30:  # one domain's addresses stay of one domain
            host = _like(_stream(key, "domain", domain), host)
        return f"{_like(s, local)}{'x' * (attempt // 60)}@{host if attempt < 30 else _like(s, host)}.{tld}"
    if kind == "ip":
        private = canon.startswith(("10.", "192.168."))
        parts = canon.split(".")
        keep = 2 if canon.startswith("192.168.") else 1 if private else 0
        limits = {1: range(1, 10), 2: range(10, 100), 3: range(100, 255)}
        return ".".join(p if k < keep else _pick(s, [str(x) for x in (limits[len(p)] if attempt < 8 else range(256))]) for k, p in enumerate(parts))
    if kind == "ipv6":
        return "".join(_pick(s, "0123456789abcdef") if c != ":" else c for c in canon)
    if kind == "aws":
        return canon[:4] + "".join(_pick(s, string.ascii_uppercase + "234567") for _ in canon[4:])
    if kind == "hex":
        return "".join(_pick(s, "0123456789abcdef") for _ in canon)
    if kind == "iban":
        body = "".join(_pick(s, string.ascii_uppercase) if c.isalpha() else _pick(s, string.digits) for c in canon[4:])
        right = 98 - iban_check(f"{canon[:2]}00{body}")
        return f"{canon[:2]}{right if iban_check(canon) == 1 else (right + 1 + next(s) % 90) % 97:02d}{body}"
    if kind == "card":
        body = canon[0] + _like(s, canon[1:-1])
        good = next(d for d in string.digits if luhn(body + d))
        return body + (good if luhn(canon) else _pick(s, [d for d in string.digits if d != good]))
    if kind == "ssn":
        area = _pick(s, [f"{x:03d}" for x in range(1, 900) if x != 666])
        return f"{area}{1 + (next(s) << 8 | next(s)) % 99:02d}{1 + (next(s) << 16 | next(s) << 8 | next(s)) % 9999:04d}"
    if kind == "phone" and len(canon) > 10:  # the country's code stays
        return canon[: len(canon) - 10] + _pick(s, "23456789") + _like(s, canon[len(canon) - 9 :])
    return _like(s, canon)


def render(mention: str, canon: str) -> str:
    """A surrogate's canonical form in a mention's writing."""
    if len([c for c in mention if c.isalnum()]) != len([c for c in canon if c.isalnum()]):
        return canon.upper() if mention.isupper() and len(mention) > 1 else canon.capitalize() if mention[:1].isupper() else canon
    chars = iter([c for c in canon if c.isalnum()])
    return "".join((x.upper() if c.isupper() else x) if c.isalnum() and (x := next(chars)) else c for c in mention)


def replace(text: str, known: dict[tuple[str, str], str], mentions: list[tuple] | None = None) -> tuple[str, int]:
    """The text with the surrogates of its entities (mentions: what find() gives), and their number."""
    out, at, n = [], 0, 0
    for a, b, kind, canon, *_ in find(text) if mentions is None else mentions:
        if a < at:
            continue
        out += [text[at:a], render(text[a:b], known[kind, canon])]
        at, n = b, n + 1
    return "".join([*out, text[at:]]), n


_ENTITY = "kind string, canon string"


def mentions(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a column of its texts' entities in the order find() gives."""
    cols = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.StructType.fromDDL("start int, end int, kind string, canon string, gender string")))])
    names = ("start", "end", "kind", "canon", "gender")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("canon", pa.string()), ("gender", pa.string())]))
        for batch in batches:
            got = [[dict(zip(names, m, strict=True)) for m in find(t)] for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(got, kind)], names=[*cols, out])
        release()

    return df.mapInArrow(run, schema)


def assign(found: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """kind, canon, surrogate: one for each row (kind, canon; gender if there), all distinct within a kind, none itself an
    entity of its kind. Names of all scripts are one kind for this. After 400 attempts the search fails loudly.
    """

    def draw(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "canon", "gender")), strict=True)
                got = [surrogate(key, k, c, attempt, g) for k, c, g in rows]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "canon", "gender")), pa.array(got, pa.string())], names=["kind", "canon", "gender", "surrogate"])

        return run

    group = F.when(F.col("kind").startswith("name"), F.lit("name")).otherwise(F.col("kind"))
    found = scratch.keep(found if "gender" in found.columns else found.withColumn("gender", F.lit("n")))
    real = found.select(group.alias("g"), F.col("canon").alias("surrogate")).distinct()
    done, left, attempt = None, found, 0
    while True:
        drawn = left.mapInArrow(draw(attempt), _ENTITY + ", gender string, surrogate string").withColumn("g", group)
        pool = drawn.join(real, ["g", "surrogate"], "left_anti").select("g", "surrogate", "kind", "canon", F.lit(1).alias("fresh"))
        if done is not None:
            pool = pool.unionByName(done.select("g", "surrogate", "kind", "canon", F.lit(0).alias("fresh")))
        first = pool.groupBy("g", "surrogate").agg(F.min(F.struct("fresh", "kind", "canon")).alias("x")).filter("x.fresh = 1")
        won = first.select("g", "surrogate", "x.kind", "x.canon")
        done = scratch.keep(won if done is None else done.unionByName(won))
        left = scratch.keep(left.join(done, ["kind", "canon"], "left_anti"))
        if left.isEmpty():
            return done.select("kind", "canon", "surrogate")
        attempt += 1
        if attempt > 400:
            raise RuntimeError("a kind of entity has fewer surrogates than entities")


def secret() -> bytes:
    """The key of $VEILFRAME_PII_KEY, or else a random one of this process, so that no surrogate can be found out by trial."""
    global _SECRET
    if _SECRET is None:
        _SECRET = os.environ["VEILFRAME_PII_KEY"].encode() if os.environ.get("VEILFRAME_PII_KEY") else secrets.token_bytes(32)
    return _SECRET


_SECRET: bytes | None = None


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """df with surrogates in its text column, and the number of entities replaced, if count is named.

    Null text stays null, empty text empty. Rows without entities stay as they are. The same key gives the same surrogates to
    the same entities of the same corpus. A column of df with count's name, in any case of letters, is replaced. Only texts
    that may hold an entity go through Python, once to find and once to replace; of the entities, those with over 1/HOT of all
    mentions, so HOT at most, are broadcast, the others joined to the texts that mention them. Original texts and the table of
    surrogates are removed from the shared folder before the result is returned; the new texts stay there.
    """
    spark = df.sparkSession
    scratch, result = Scratch(spark, "pii"), Scratch(spark, "pii-out")
    cols = [c for c in df.columns if not count or c.lower() != count.lower()]
    rid, found, map_ = (fresh(df, c) for c in ("rid", "mentions", "map"))
    may = F.coalesce(F.col(text).rlike(TRIGGER), F.lit(False))
    rows = scratch.keep(mentions(df.select(*cols).filter(may), text, found).withColumn(rid, F.monotonically_increasing_id()))
    each = rows.select(F.col(rid).alias("rid"), F.inline(found))
    told = lambda g: F.max(F.col("gender") == g)
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n")
    entities = scratch.keep(each.groupBy("kind", "canon").agg(F.count("*").alias("n"), told("m").alias("m"), told("f").alias("f")).select("kind", "canon", "n", gender.alias("gender")))
    known = assign(entities.select("kind", "canon", "gender"), key, scratch).join(entities.select("kind", "canon", "n"), ["kind", "canon"])
    total = entities.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(total / HOT, 1_000)
    known = scratch.keep(known)
    pairs = each.select("rid", "kind", "canon").distinct().join(F.broadcast(known.filter(hot).drop("n")), ["kind", "canon"], "left")
    rare = pairs.filter("surrogate IS NULL").drop("surrogate").join(known.filter(~hot).drop("n"), ["kind", "canon"])
    maps = pairs.filter("surrogate IS NOT NULL").unionByName(rare).groupBy("rid").agg(F.collect_list(F.struct("kind", "canon", "surrogate")).alias(map_))
    joined = rows.join(maps.withColumnRenamed("rid", f"{rid}_"), F.col(rid) == F.col(f"{rid}_"), "left").select(*cols, found, map_)
    out_cols = [*cols, *([count] if count else [])]
    schema = df.select(*cols).schema
    schema = schema.add(count, "integer") if count else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ns = [], []
            for t, ms, m in zip(*(batch.column(c).to_pylist() for c in (text, found, map_)), strict=True):
                new, n = replace(t, {(x["kind"], x["canon"]): x["surrogate"] for x in m or ()}, [tuple(x.values()) for x in ms])
                texts.append(new), ns.append(n)
            data = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in cols]
            yield pa.RecordBatch.from_arrays(data + ([pa.array(ns, pa.int32())] if count else []), names=out_cols)
        release()

    rest = df.select(*cols).filter(~may)
    if count:
        rest = rest.withColumn(count, F.lit(0))
    try:
        return result.keep(joined.mapInArrow(run, schema)).unionByName(rest)
    finally:
        scratch.drop()
