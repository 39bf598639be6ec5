"""Keyed surrogates for personal data.

Every detected entity is replaced by a value of its own type and format: digits
by digits, vowels by vowels, consonants by consonants of the same script, given
names by given names of the same gender and script, with check digits and
address classes kept.  Surrogates come from keyed permutations of the values of
one format, so different entities get different surrogates and every mention of
an entity gets the same one, on any executor and without a shared table.

A permutation may still hit a value that the corpus itself contains.  Such
entities are found by a join of all surrogates with all originals and take the
next permutation until none is left; short values grow if their format is full.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpuslens.llm.scratch import by_bytes, stored, tidy

# Given names by gender and script, and titles that announce a surname (fixed values).
GIVEN = {
    ("f", "latin"): "Anna Maria Elena Laura Sofia Julia Emma Clara Sarah Emily Olivia Charlotte Jennifer Elizabeth Susan Karen Nancy Lisa Margaret Sandra Ingrid Heike Ursula Petra Monika Camille Chloé Élodie Mathilde Céline Isabel Carmen Lucía Pilar Dolores".split(),
    ("m", "latin"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Peter Paul Hans Klaus Jürgen Wolfgang Stefan Uwe Pierre Jacques François Luc Olivier Carlos Javier Miguel Pablo Diego Fernando Antonio".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("m", "cyrillic"): "Александр Сергей Дмитрий Андрей Алексей Михаил Иван Николай Владимир Павел".split(),
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα".split(),
    ("m", "greek"): "Γεώργιος Ιωάννης Κωνσταντίνος Δημήτριος Νικόλαος Παναγιώτης Βασίλειος Χρήστος".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Господин Госпожа Κύριος Κυρία".split()
CLASSES = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àâáäéèêëíîïóôöúûüù", "çñ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αειουηω", "βγδζθκλμνξπρστφχψ"]
# Ranges whose remaining lower-case letters, or letters without case, form a class each (fixed values).
RANGES = (
    (0xDF, 0x17F), (0x180, 0x24F), (0x1E00, 0x1EFF), (0x370, 0x3FF), (0x1F00, 0x1FFF), (0x400, 0x52F), (0x560, 0x588), (0x5D0, 0x5EA), (0x621, 0x64A), (0x671, 0x6D3),
    (0x904, 0x939), (0x985, 0x9B9), (0xA05, 0xA39), (0xB85, 0xBB9), (0xC05, 0xC39), (0xE01, 0xE30), (0x10D0, 0x10FA), (0x1200, 0x1357), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)


def _further(taken: set[str]) -> list[str]:
    """Classes of ``RANGES``; letters that cannot change their case one to one stand apart from the others."""
    out = []
    for a, z in RANGES:
        free = [c for c in map(chr, range(a, z + 1)) if c.isalpha() and c.lower() == c and c not in taken]
        plain = [c for c in free if len(c.upper()) == 1 and c.upper().lower() == c]
        paired = set(plain)
        out += ["".join(plain), "".join(c for c in free if c not in paired)]
    return [k for k in out if len(k) > 1]


CLASSES += _further(set("".join(CLASSES)))
PLACES = {c: (n, i) for n, k in enumerate(CLASSES) for i, c in enumerate(k)}
HEX = "0123456789abcdef"
WIDEN = 12
RESERVED_DOMAINS = (".example.com", ".example.org", ".example.net", ".test", ".invalid", "@example.com", "@example.org", "@example.net")

_NAME = r"[^\W\d_][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_NUMBERS = re.compile(
    r"(?P<email>[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})"
    r"|(?P<key>\bAKIA[0-9A-Z]{16}\b)"
    r"|(?i:(?:password|secret|api[_ -]?key|(?P<long>token))[\"']?\s*(?:=>|:=|[=:])\s*)(?P<quote>[\"'])?(?!AKIA[0-9A-Z]{16}\b)"
    r"(?P<secret>(?(long)[^\s\"',;&<>()]{15,}[\w/+=-]|(?(quote)[^\"'\n]{6,}|[^\s\"',;]{6,})))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])(?:\d{4}[ -]){3}\d{4}(?![\d-])|(?<!\d)\d{15,16}(?!\d))"
    r"|(?i:\b(?:phone|telephone|tel|mobile|cell|fax|call)\b[.:]?[ :]{1,2})(?P<number>\d{7,12})(?!\d)"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{2,4}[ .-]\d{3,4}|\d{2,4}[ .-]\d{3,4}[ .-]\d{3,4})(?!\d)|(?<![\w+])\+\d{8,14}(?!\d))"
)
_GIVEN = {n: (g, s) for (g, s), names in GIVEN.items() for n in names}
_NAMES = re.compile(
    rf"\b(?:(?:{'|'.join(TITLES)})\.?(?P<gap>[  ])(?:(?P<g1>{'|'.join(map(re.escape, _GIVEN))})(?P<gap1>[  ]))?(?P<s1>{_NAME})(?:(?P<gap3>[  ])(?!(?:{'|'.join(map(re.escape, _GIVEN))})\b)(?P<s3>{_NAME}))?"
    rf"|(?P<g2>{'|'.join(map(re.escape, _GIVEN))})(?P<gap2>[  ])(?P<s2>{_NAME}))"
)
# Where matches may begin: sets of characters and plain words, which the engine finds without trying every branch of
# the patterns above.  "ı", "İ", "ſ" and the Kelvin sign are letters of (?i) words too.
_NAME_STARTS = re.compile("|".join(map(re.escape, sorted({*TITLES, *_GIVEN}))))
_DIGIT = re.compile(r"[\d@]")  # with one of these, AKIA or a secret's word a text can hold a match
_PAIRED = re.compile(r"[=:]")
_SECRETS = re.compile(r"[pPsSſaAtT](?:(?<=[pP])(?i:assword)|(?<=[sSſ])(?i:ecret)|(?<=[aA])(?i:pi[_ -]?key)|(?<=[tT])(?i:oken))[\"']?\s*[=:]")
_NUMBER_STARTS = re.compile(
    r"[\d+(A-Zpsſatmcf](?:(?<=[\d+])|(?<=\()\d|(?<=A)KIA|(?<=[A-Z])[A-Z]\d|(?<=[pP])(?i:assword|hone)|(?<=[sSſ])(?i:ecret)"
    r"|(?<=[aA])(?i:pi[_ -]?key)|(?<=[tT])(?i:oken|el)|(?<=[mM])(?i:obile)|(?<=[cC])(?i:all|ell)|(?<=[fF])(?i:ax))"
)
_LOCAL = re.compile(r"(?<![\w.+-])[\w.+-]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
_LETTER = re.compile(r"[A-Za-z0-9]")


def _names(text: str) -> Iterator[re.Match]:
    """What ``_NAMES.finditer`` finds."""
    at = 0
    while start := _NAME_STARTS.search(text, at):
        m = _NAMES.match(text, start.start())
        at = m.end() if m else start.start() + 1
        if m:
            yield m


def _numbers(text: str) -> Iterator[re.Match]:
    """What ``_NUMBERS.finditer`` finds."""
    if not _DIGIT.search(text) and "AKIA" not in text and not (_PAIRED.search(text) and _SECRETS.search(text)):
        return
    # Parts before an @ that a domain follows; an address begins at any letter or digit of such a part.
    mails = [(m.start(), m.end() - 1) for m in _LOCAL.finditer(text) if _DOMAIN.match(text, m.end())] if "@" in text else []
    mails.reverse()
    at, start, mail = 0, _NUMBER_STARTS.search(text), None
    while True:
        if start and start.start() < at:
            start = _NUMBER_STARTS.search(text, at)
        if mail and mail.start() < at:
            mail = None
        while mails and not mail:
            a, z = mails[-1]
            mail = _LETTER.search(text, max(a, at), z) if at < z else None
            if not mail:
                mails.pop()
        if not start and not mail:
            return
        begin = min(m.start() for m in (start, mail) if m)
        m = _NUMBERS.match(text, begin)
        at = m.end() if m else begin + 1
        if m:
            yield m


def _upper(word: str) -> bool:
    return word[:1].isupper()


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the entities of a text, in order and without overlap.

    Kinds: email, key, secret, iban, ip, ssn, card, phone, given, surname.  A
    name found anywhere in the text is found wherever it stands capitalised.
    """
    spans = []
    for m in _numbers(text):
        spans.append((*m.span(m.lastgroup), "phone" if m.lastgroup == "number" else m.lastgroup))
    people = []
    for m in _names(text):
        part = "1" if m["s1"] else "2"
        if _upper(m[f"s{part}"]):
            if m[f"g{part}"]:
                people.append((*m.span(f"g{part}"), "given"))
            several = [f"s{part}", "s3"] if part == "1" and _upper(m["s3"] or "") else [f"s{part}"]
            for a, z in map(m.span, several):
                people.append((a, z - 2 if text[z - 2 : z] in ("'s", "’s") and z - a > 3 else z, "surname"))
    if people:
        # A name that serves as both is a given name only where it was found as one.
        known = {text[a:z].lower(): k for a, z, k in sorted(people, key=lambda p: p[2])}
        for m in re.finditer(rf"(?i)(?<![^\W_])(?:{'|'.join(map(re.escape, sorted(known, key=lambda n: (-len(n), n))))})(?![^\W_])", text):
            if _upper(m[0]) and m[0].lower() in known:
                people.append((*m.span(), known[m[0].lower()]))
        taken = {p[:2]: p for p in reversed(people)}  # the first finding of a place counts
        spans += taken.values()
    spans.sort(key=lambda s: (s[0], -s[1]))
    out, end = [], 0
    for s in spans:
        if s[0] >= end:
            out.append(s)
            end = s[1]
    return out


def canonical(kind: str, mention: str) -> str:
    """The form in which mentions of one entity agree."""
    if kind in ("ssn", "card", "phone"):
        return re.sub(r"\D", "", mention)
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "given" and mention not in _GIVEN:  # in capitals
        return next((n for n in _GIVEN if n.lower() == mention.lower()), mention)
    return mention.lower() if kind in ("email", "surname") else mention


def _round(key: bytes, tweak: str, half: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{tweak}|{half}".encode(), key=key, digest_size=32).digest(), "big")


def permute(key: bytes, tweak: str, digits: list[int], radixes: list[int]) -> list[int]:
    """Keyed permutation of all digit strings with these radixes: a ten-round Feistel network."""
    if len(digits) < 2:
        return [(d + _round(key, tweak, r)) % r for d, r in zip(digits, radixes)]
    cut = len(digits) // 2
    sizes = [1, 1]
    values = [0, 0]
    for i, (d, r) in enumerate(zip(digits, radixes)):
        side = i >= cut
        values[side] = values[side] * r + d
        sizes[side] *= r
    for n in range(10):
        side = n % 2
        values[side] = (values[side] + _round(key, f"{tweak}|{n}", values[1 - side])) % sizes[side]
    out = []
    for side, part in ((0, radixes[:cut]), (1, radixes[cut:])):
        v, own = values[side], []
        for r in reversed(part):
            v, d = divmod(v, r)
            own.append(d)
        out += reversed(own)
    return out


def _shaped(key: bytes, tweak: str, text: str, classes: list[str]) -> str:
    """The text with every character of a class replaced within its class; case and all else stay."""
    places = PLACES if classes is CLASSES else {c: (n, i) for n, k in enumerate(classes) for i, c in enumerate(k)}
    found = [(i, *places[c.lower()]) for i, c in enumerate(text) if c.lower() in places]
    shape = "".join(str(n) if n < 9 else f"<{n}>" for _, n, _ in found)
    out = list(text)
    for (i, n, _), d in zip(found, permute(key, f"{tweak}|{shape}", [p for *_, p in found], [len(classes[n]) for _, n, _ in found])):
        out[i] = classes[n][d].upper() if text[i].isupper() else classes[n][d]
    return "".join(out)


def _luhn(digits: str) -> int:
    """Check digit of these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _ip_class(parts: list[int]) -> int:
    a, b = parts[:2]
    if a == 10 or (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
        return 1 if a == 10 else 2 if a == 192 else 3
    return 4 if a in (0, 127) or a >= 224 or (a, b) == (169, 254) else 0


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """Surrogate of a canonical value; ``attempt`` chooses the permutation.

    After ``WIDEN`` attempts e-mails, surnames and secrets grow by a character an
    attempt, as short ones may leave no free value of their own length.
    """
    tweak = f"{kind}|{attempt}"
    if kind in ("email", "surname", "secret"):
        local, at, domain = value.partition("@") if kind == "email" else (value, "", "")
        own = next((CLASSES[PLACES[c.lower()][0]] for c in local if c.lower() in PLACES), "")
        if not own:  # nothing that could be replaced, as in ******
            n = _round(key, f"{tweak}|{local}", 0)
            local = "".join(CLASSES[2][(n >> 8 * i) % 20] + CLASSES[1][(n >> 8 * i) % 5] for i in range(max(2, min(32, len(local) // 2))))
        value = local + (own or CLASSES[1])[0] * max(0, attempt - WIDEN) + at + domain
    if kind == "given":
        group = _GIVEN[value]
        ranked = sorted(GIVEN[group], key=lambda n: _round(key, f"{tweak}|{n}", 0))
        return ranked[(ranked.index(value) + 1) % len(ranked)]
    if kind == "email":
        local, _, domain = value.partition("@")
        if not value.endswith(RESERVED_DOMAINS):
            name, _, top = domain.rpartition(".")
            domain = f"{_shaped(key, f'{tweak}|domain', name, CLASSES)}.{top}"
        return f"{_shaped(key, tweak, local, CLASSES)}@{domain}"
    if kind == "card":
        new = _shaped(key, tweak, value[:-1], CLASSES)
        return new + str((_luhn(new) + int(value[-1]) - _luhn(value[:-1])) % 10)
    if kind == "ip":
        parts = list(map(int, value.split(".")))
        own = _ip_class(parts)
        while True:  # walks on inside the permutation, which stays one on the addresses of a class
            parts = permute(key, tweak, parts, [256] * 4)
            if _ip_class(parts) == own:
                return ".".join(map(str, parts))
    if kind == "iban":
        body = _shaped(key, tweak, value[4:], CLASSES)
        number = "".join(str(int(c, 36)) for c in f"{body}{value[:2]}00")
        return f"{value[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "phone":
        lead = 1 if len(value) == 11 and value[0] == "1" else max(0, len(value) - 10)
        return value[:lead] + _shaped(key, tweak, value[lead:], CLASSES)
    if kind == "key":
        return value[:4] + _shaped(key, tweak, value[4:], CLASSES)
    if kind == "secret" and value in (value.lower(), value.upper()) and set(value.lower()) <= set(HEX):
        return _shaped(key, tweak, value, [HEX]) if value == value.lower() else _shaped(key, f"{tweak}|upper", value.lower(), [HEX]).upper()
    return _shaped(key, tweak, value, CLASSES)


def rewrite(key: bytes, text: str, attempts: dict[str, int]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds of its entities; ``attempts`` by kind, tab and value."""
    out, kinds, end = [], [], 0
    for a, z, kind in find(text):
        mention = text[a:z]
        value = canonical(kind, mention)
        new = surrogate(key, kind, value, attempts.get(f"{kind}\t{value}", 0))
        if kind in ("ssn", "card", "phone", "iban"):  # into the mention's own format
            chars = iter(new)
            new = "".join(next(chars) if c.isalnum() else c for c in mention)
        elif kind in ("email", "surname"):
            rest = new[len(mention) :]
            new = "".join(n.upper() if m.isupper() else n for n, m in zip(new, mention)) + (rest.upper() if mention[-1:].isupper() else rest)
        elif kind == "given" and mention.isupper():
            new = new.upper()
        out += [text[end:a], new]
        kinds.append(kind)
        end = z
    return "".join(out) + text[end:], kinds


def entities(docs: DataFrame) -> DataFrame:
    """Distinct ``kind, value`` of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(k, canonical(k, t[a:z])) for t in batch.column(0).to_pylist() if t for a, z, k in find(t)}
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], names=["kind", "value"])

    return docs.select(F.col("text").cast("string")).mapInArrow(tidy(run), "kind string, value string").distinct()


def collisions(docs: DataFrame, key: bytes, *, rounds: int = 200) -> DataFrame:
    """``entity, attempt`` of entities whose first surrogate is an original of the corpus or another's surrogate.

    A retry must differ from every original, from all first surrogates and from
    the retries already settled; of equal ones of a round the least value keeps
    it.  Goes on until none collides, and raises ``ValueError`` if some still do
    after ``rounds``: their format has too few values.
    """

    def invent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, *row) for row in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "value", "attempt", "made"])

    # A given name's surrogates are the given names themselves; only their order is secret.
    known = stored(entities(docs).filter("kind <> 'given'"), "entities")
    originals = known.select("kind", F.col("value").alias("made"))
    schema = "kind string, value string, attempt int, made string"
    first = stored(known.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(invent, schema), "first")
    twice = first.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min("value").alias("least")).filter("n > 1")
    twice = first.join(twice, ["kind", "made"]).filter(F.col("value") > F.col("least"))
    bad = first.join(originals, ["kind", "made"], "left_semi").select("kind", "value", "attempt").union(twice.select("kind", "value", "attempt"))
    bad = stored(bad.distinct(), "collisions")
    taken = originals.union(first.select("kind", "made"))
    settled = None
    for _ in range(rounds):
        if not bad.limit(1).count():
            break
        made = stored(bad.withColumn("attempt", F.col("attempt") + 1).mapInArrow(invent, schema), "made")
        free = made.join(taken, ["kind", "made"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "made"), ["kind", "made"], "left_anti")
        good = free.groupBy("kind", "made").agg(F.min_by("attempt", "value").alias("attempt"), F.min("value").alias("value")).select(*made.columns)
        settled = stored(good if settled is None else settled.union(good), "settled")
        bad = stored(made.join(settled, ["kind", "value"], "left_anti").select("kind", "value", "attempt"), "collisions")
    else:
        if left := bad.groupBy("kind").count().collect():
            raise ValueError(f"no free surrogates after {rounds} rounds: {', '.join(f'{r["count"]} of kind {r.kind}' for r in left)}")
    settled = first.limit(0) if settled is None else settled
    return settled.select(F.concat_ws("\t", "kind", "value").alias("entity"), "attempt")


def pseudonymize(docs: DataFrame, key: bytes, *, small: int = 50_000) -> DataFrame:
    """``docs`` with surrogates in ``text``, and a column ``entity_kinds`` (array of kinds in order).

    Null texts stay null with no kinds; texts without entities stay as they are;
    all other columns and repeated rows are kept, an empty table stays empty, and
    only a column named ``entity_kinds`` is replaced.  Up to ``small`` collided
    entities (a few megabytes) travel with the tasks; beyond that every row gets
    those of its own text by a join.
    """
    docs = docs.drop("entity_kinds")
    text_at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField("entity_kinds", ArrayType(StringType()))])
    retries = stored(collisions(docs, key), "retries")
    # Columns go by place, whatever their names hold.
    names = [f"c{i}" for i in range(len(docs.columns))]
    docs = docs.toDF(*names)
    text = docs[f"c{text_at}"].cast("string")
    few = retries.limit(small + 1).count() <= small
    shared = {r["entity"]: r["attempt"] for r in retries.collect()} if few else {}
    rows = docs
    if not few:

        def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = {(h, f"{k}\t{canonical(k, t[a:z])}") for t, h in zip(*(batch.column(i).to_pylist() for i in range(2))) if t for a, z, k in find(t)}
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["text_hash", "entity"])

        hashed = docs.select(text.alias("text"), F.xxhash64(text).alias("text_hash"))
        own = hashed.mapInArrow(mentions, "text_hash long, entity string").distinct().join(retries, "entity")
        own = own.groupBy("text_hash").agg(F.collect_list("entity").alias("entities"), F.collect_list("attempt").alias("attempts"))
        rows = docs.join(own, F.xxhash64(text) == own["text_hash"], "left").select(*names, "entities", "attempts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_bytes(whole, text_at)):
            texts = batch.column(text_at).to_pylist()
            extra = [shared] * len(texts)
            if not few:
                extra = [dict(zip(e or [], a or [])) for e, a in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist())]
            done = [(None, []) if t is None else rewrite(key, t, x) for t, x in zip(texts, extra)]
            columns = [pa.array([d[0] for d in done], pa.string()) if i == text_at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.list_(pa.string()))], names=schema.names)

    return rows.mapInArrow(tidy(run), schema)
