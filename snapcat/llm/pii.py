"""Personal data with offset-preserving deobfuscation.

Four detectors (email, ip, card, phone) run over the text as it is.  Where the text holds
disguises, a transducer rewrites homoglyphs, full-width and styled characters, invisible
characters, spelled digits and at/dot disguises into plain characters and remembers for
every written character the source range it came from; the same detectors run over the
rewritten text, and their spans are mapped back.  Such spans are added where they overlap
no span of the same kind found directly, or contain it with more of the same word.  Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcat.llm.common import load, small_batches

KINDS = ("email", "ip", "card", "phone")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins: later starts in the run fail as the first did.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Letters of other scripts that look like Latin ones (fixed values).
HOMOGLYPHS = dict(zip(
    "аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅοαικνρυτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlABEKMHOPCTXIJSoaikvputABEZHIKMNOPTYX"))
SPELLED = {w: str(i) for i, words in enumerate((
    "zero oh null", "one eins uno un", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre",
    "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf",
)) for w in words.split()}
AT, DOT = "at|arroba|ät|chez", "dot|punkt|punto|point"
INVISIBLE = "­​‌‍⁠﻿"
#: Decimal digits of other scripts (each script has ten in a row).
OTHER_DIGITS = "".join(f"{chr(c)}-{chr(c + 9)}" for c in range(0x80, 0x20000) if unicodedata.decimal(chr(c), None) == 0)
#: Words that are no mailbox before ``at`` and a host (pronouns, particles, verbs and nouns of a page).
NEVER = frozenset(
    "a about above account all also am an and any anything are arrive arrived as available based be been bought browse buy by check click "
    "content deal details directly docs document documentation down download everything files find first for found free from get go good has "
    "have her here him homepage hosted i images in is it items join latest line list listed live log login look looked looking looks "
    "maintained me meet met more much my new not now of off offer offered on one online only or our out over page pages posted prices "
    "products program project published purchase purchased read released reviews see shopping site sold something source start started "
    "stay that the their them there these they things this those through to today together up us version visit was watch we website were "
    "what worked working works written you your yourself email mail write order register registered sign".split())
#: Usual names of shared mailboxes, which are words of prose too.
ROLES = frozenset(
    "abuse accounts admin billing booking bookings careers contact enquiries events feedback hello help hr info information jobs legal "
    "marketing media news newsletter office orders postmaster press privacy reservations sales security service shop staff store support "
    "team tickets web webmaster work".split())
#: Words before a mailbox, and words that make what follows a noun of the sentence.
LABELS = frozenset(
    "address am ask at contact courriel cc correo dm e-mail email emails is kontakt mail mailto message or reach schreib send sende to via write".split())
NOUN_AHEAD = frozenset(
    "a about all an any best buy by cheap each every few find for from get great her his in its latest less many more most my new no of on our "
    "see some such the their these this those with your".split())
_digit = "|".join(sorted(SPELLED, key=len, reverse=True))

#: A host with plain dots: no time of day, no path behind it, and an ending that is not written like the start of a sentence.
HOST = r"(?![0-9]+\.[ap]m\b)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?-i:[a-z]{2,}|[A-Z]{2,})(?![\w-]|/\w)"
#: What becomes one space between spelled digits.
BETWEEN = re.compile(r"[\s.,:;()\-\u2010-\u2015/_]+")

#: One alternative per rewriting rule; the name says which.
RULES = re.compile(
    rf"(?P<at>[\[({{<]\s*(?:{AT}|@)\s*[\])}}>]\s*)"
    rf"|(?P<dot>[\[({{<]\s*(?:{DOT}|\.)\s*[\])}}>]\s*)"
    rf"|(?P<wordat>(?<=\w)\s+(?:{AT})\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:\s+(?:{DOT})\s+|\s*[\[({{<]\s*(?:{DOT}|\.)\s*[\])}}>]\s*)[A-Za-z]))"
    rf"|(?P<hostat>(?<=\w)\s+(?:{AT})\s+(?={HOST}))"
    rf"|(?P<worddot>(?<=\w)\s+(?:{DOT})\s+(?=\w))"
    rf"|(?P<plus>\bplus[\s.,:;-]+(?=(?:{_digit})\b|[0-9]))"
    rf"|(?P<spelled>(?<![^\W_])(?:{_digit})(?![^\W_]))"
    rf"|(?P<gone>[{INVISIBLE}])"
    rf"|(?P<glyph>[{''.join(HOMOGLYPHS)}！-～\U0001d400-\U0001d7ff{OTHER_DIGITS}①-⑨])",
    re.IGNORECASE)
BRACKETED = re.compile(rf"[\[({{<]\s*(?:{AT}|{DOT}|@|\.)\s*[\])}}>]", re.IGNORECASE)
DOT_WORD = re.compile(rf"\b(?:{DOT})\b", re.IGNORECASE)
DOT_WORDS = tuple(DOT.split("|"))
ODD = re.compile(rf"[{INVISIBLE}{''.join(HOMOGLYPHS)}！-～\U0001d400-\U0001d7ff{OTHER_DIGITS}①-⑨]")
AT_HOST = re.compile(rf"(?:{AT})\s+(?:{HOST})", re.IGNORECASE)
WORD = re.compile(r"[^\W_]+")
SPACED = re.compile(r"\s")
#: The word right before a place, with nothing but a blank between; looked for in so many characters.
PRECEDING = re.compile(r"([^\W_][\w'-]*)?[\x20\t]*\Z")
REACH = 40
#: Spelled digits are rewritten where at least so many follow each other (figures may stand between them).
SPELLED_RUN = 3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; each belongs to one ``@`` and the run of characters before it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1] in LOCAL:
            lo -= 1
        m = EMAIL.match(text, lo) if lo < at else None
        if m:
            found.append(m.span())
            end = m.end()
        else:
            end = max(end, lo)
        at = text.find("@", max(end, at + 1))
    return found


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def spelled_words(text: str) -> set[int]:
    """Starts of spelled digits in runs of SPELLED_RUN or more, whatever punctuation stands between them."""
    if sum(map(SPELLED.__contains__, WORD.findall(text.lower()))) < SPELLED_RUN:
        return set()
    found, run = set(), []
    for m in WORD.finditer(text):
        word = m.group().lower()
        if word in SPELLED:
            run.append(m.start())
        elif not word[:1].isdigit():
            if len(run) >= SPELLED_RUN:
                found.update(run)
            run = []
    return found | set(run) if len(run) >= SPELLED_RUN else found


def disguised(text: str) -> bool:
    """Whether the transducer can change a detection: brackets or words for at/dot, a host behind an at, or an odd character."""
    if not text.isascii() and ODD.search(text):
        return True
    if any(c in text for c in "[({<") and BRACKETED.search(text):
        return True
    low = text.lower()
    return any(w in low for w in DOT_WORDS) and DOT_WORD.search(low) is not None or AT_HOST.search(text) is not None


def in_prose(text: str, lo: int) -> bool:
    """Whether the word that ends at ``lo``, before ``at`` and a host, is prose rather than a mailbox.

    A name with figures, dots or the like is a mailbox, a particle never is.  Any other word is one where an address is
    announced: at the start of a line or after punctuation, or after a label (``write to``, ``reach``).  After an article
    or the like it is a noun; after any other word, a shared mailbox's name is prose and a capitalised name is not.
    """
    begin = lo
    while begin > 0 and text[begin - 1] in LOCAL:
        begin -= 1
    word = text[begin:lo]
    if word.lower() in NEVER:
        return True
    if not word.isalpha():
        return False
    before = PRECEDING.search(text, max(0, begin - REACH), begin)
    if before is None or not before.group(1):
        return False
    previous = before.group(1).lower()
    if previous in LABELS:
        return False
    return previous in NOUN_AHEAD or word.lower() in ROLES or not word[0].isupper()


def plain(text: str, spelled: set[int]) -> tuple[str, list[int], list[int]]:
    """Rewritten text, and for each of its characters where its source begins and ends."""
    out: list[str] = []
    starts: list[int] = []
    ends: list[int] = []

    def copy(lo: int, hi: int) -> None:
        out.append(text[lo:hi])
        starts.extend(range(lo, hi))
        ends.extend(range(lo + 1, hi + 1))

    done, after_digit = 0, -1
    for m in RULES.finditer(text):
        lo, hi, rule = m.start(), m.end(), m.lastgroup
        if rule in ("at", "dot"):
            # White space before the bracket goes too; looked for from here, as a pattern would try it at every blank.
            while lo > done and text[lo - 1].isspace():
                lo -= 1
        if done == after_digit and lo in spelled and BETWEEN.fullmatch(text, done, lo):
            out.append(" ")
            starts.append(done)
            ends.append(lo)
        else:
            copy(done, lo)
        done = hi
        if rule == "gone":
            continue
        if rule == "hostat" and text[lo:hi].strip().lower() in ("at", "chez") and in_prose(text, lo):
            copy(lo, hi)
            continue
        if rule in ("at", "wordat", "hostat"):
            new = "@"
        elif rule in ("dot", "worddot"):
            new = "."
        elif rule == "plus":
            new = "+"
        elif rule == "spelled":
            new = SPELLED[m.group().lower()] if lo in spelled and m.group().lower() in SPELLED else m.group()
            if new == m.group():
                copy(lo, hi)
                continue
            after_digit = hi
        else:
            decimal = unicodedata.decimal(m.group(), None)
            new = HOMOGLYPHS.get(m.group()) or (unicodedata.normalize("NFKC", m.group()) if decimal is None else str(decimal))
        out.append(new)
        starts.extend([lo] * len(new))
        ends.extend([hi] * len(new))
    copy(done, len(text))
    return "".join(out), starts, ends


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans found directly, and all spans with those found behind disguises."""
    base = detect(text)
    spelled = spelled_words(text)
    if not spelled and not disguised(text):
        return base, base
    rewritten, starts, ends = plain(text, spelled)
    found = list(base)
    for s, kind, e in detect(rewritten):
        lo, hi = starts[s], ends[e - 1]
        if text[lo:hi] != rewritten[s:e] and all(
            k != kind or b <= lo or hi <= a or lo <= a and b <= hi and not SPACED.search(text[lo:a] + text[b:hi]) for a, k, b in base
        ):
            found.append((lo, kind, hi))
    return base, sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str) -> str:
    """Text with every span replaced by its kind in brackets; overlapping spans go as one, under the first one's kind."""
    _, spans = find_spans(text)
    out, done = [], 0
    for s, kind, e in spans:
        if s >= done:
            out += [text[done:s], f"[{KINDS[kind].upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def find_pii(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (direct spans), base and spans as text.

    A NULL or empty text has no spans; repeated rows give repeated results; other columns are ignored.
    """
    small_batches(documents.sparkSession)
    kinds = KINDS

    def run(batches):
        for b in batches:
            counts: list[list[int]] = [[] for _ in kinds]
            bases, everything = [], []
            for text in b.column(1).to_pylist():
                base, spans = find_spans(text or "")
                for k, n in enumerate(counts):
                    n.append(sum(kind == k for _, kind, _ in base))
                bases.append(written(base))
                everything.append(written(spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(n, pa.int64()) for n in counts), pa.array(bases, pa.string()), pa.array(everything, pa.string())],
                ["doc_id", *(f"n_{k}" for k in kinds), "base", "spans"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")


def redacted(documents: DataFrame) -> DataFrame:
    """Documents with personal data replaced in ``text`` and ``n_chars`` set to its new length; NULL stays NULL."""
    small_batches(documents.sparkSession)
    names, schema = documents.columns, T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema])
    at = names.index("text")

    def run(batches):
        for b in batches:
            texts = pa.array([None if t is None else redact(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], names)

    out = documents.mapInArrow(run, schema)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType))
    return out


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(load(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
