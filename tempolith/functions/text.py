"""String expressions (F1-F3, F10-F13) as native Column builders.

Spark has no Unicode normalisation function, so accent folding is a
``translate`` table generated at import time from ``unicodedata`` NFKD over all
of Unicode (a rule, not a hand list); characters that fold to several letters
are spelled out one by one, only in rows that hold one.  Everything runs
inside whole-stage codegen.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters without an NFKD decomposition to ASCII that a
# transliterating fold spells out (used only by the folded form, F2); Greek and
# Cyrillic in their lower case, capitals follow by rule.
TRANSLIT_EXTRA = {
    "ß": "ss", "ẞ": "SS", "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ı": "i",
    "’": "'", "‘": "'",
}
TRANSLIT_GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
TRANSLIT_CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia", "і": "i", "ї": "i", "є": "ie", "ґ": "g",
    "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ў": "u",
}


def _translit(ch: str) -> str | None:
    if ch in TRANSLIT_EXTRA:
        return TRANSLIT_EXTRA[ch]
    low = ch.lower()
    rep = TRANSLIT_GREEK.get(low, TRANSLIT_CYRILLIC.get(low))
    return rep if rep is None or low == ch else rep.capitalize()


#: What may stand before and inside a letter's own name in its Unicode name.
_NAMED = re.compile(r"(?:LETTER|CHARACTER|SYLLABLE|VOWEL SIGN|SIGN|CHOSEONG|JUNGSEONG|JONGSEONG|DIGIT) (.+)$")
_KINDS = {"SMALL", "CAPITAL", "FINAL", "INITIAL", "ISOLATED", "MEDIAL", "LETTER", "MODIFIER", "INDEPENDENT", "VOWEL"}
HANGUL = (0xAC00, 0xD7A3)


@lru_cache(maxsize=None)
def hangul_parts() -> tuple[list[str], list[str], list[str]]:
    """Romanised leading consonants, vowels and final consonants, read off the names of the syllables that hold them."""
    name = lambda lead, vowel, tail: unicodedata.name(chr(HANGUL[0] + (lead * 21 + vowel) * 28 + tail)).split()[-1].lower()
    silent = next(k for k in range(19) if name(k, 0, 0) == "a")
    return [name(k, 0, 0)[:-1] for k in range(19)], [name(silent, k, 0) for k in range(21)], [name(silent, 0, k)[1:] for k in range(28)]


def _spelled_name(ch: str) -> str:
    """A letter, vowel sign or digit beyond the tables by its Unicode name: GEORGIAN LETTER BAN is "ban", HIRAGANA LETTER
    KA "ka"; "" for what is neither or has no such name."""
    lead, vowel, tail = hangul_parts()
    cp, kind = ord(ch), unicodedata.category(ch)
    for start, names in ((0x1100, lead), (0x1161, vowel), (0x11A7, tail)):
        if start <= cp < start + len(names):
            return names[cp - start]
    if kind == "Nd":
        return str(unicodedata.digit(ch))
    found = _NAMED.search(unicodedata.name(ch, "")) if kind[0] == "L" or kind in ("Mc", "Mn") and "VOWEL" in unicodedata.name(ch, "") else None
    words = found[1].split(" WITH ")[0].split() if found else []
    return re.sub(r"[^a-z0-9]", "", "".join(w for w in words if w not in _KINDS or len(words) == 1).lower())


def spell_out(ch: str) -> str:
    """What a character becomes in the transliterating fold: plain Python, one character at a time."""
    parts = ch if _translit(ch) is not None else unicodedata.normalize("NFKD", ch)
    own = "" if parts[:1].isascii() or _translit(parts[:1]) is not None else _spelled_name(ch)
    out = own or "".join(p if p.isascii() else _translit(p) if _translit(p) is not None else _spelled_name(p) for p in parts)
    if out.encode("ascii", "ignore") or unicodedata.category(ch)[0] not in "LN" or _translit(ch) is not None:
        return out.encode("ascii", "ignore").decode("ascii")
    return f"u{ord(ch):x}"


def _by_rule(cp: int) -> bool:
    """Characters that are spelled by an expression instead of a table: Hangul syllables, and ideographs by their code."""
    return HANGUL[0] <= cp <= HANGUL[1] or 0x3400 <= cp <= 0x9FFF or 0x20000 <= cp


@lru_cache(maxsize=None)
def _fold_tables(transliterate: bool) -> tuple[str, str, dict]:
    """(from, to, several): one-letter folds for translate(), and characters that become several letters."""
    src, dst, several = [], [], {}
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if transliterate:
            folded = "" if _by_rule(cp) else spell_out(ch)
        else:
            folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1 and folded != f"u{cp:x}":
            several[ch] = folded
    return "".join(src), "".join(dst), several


#: Code points that share one table where characters are spelled out, so that a look-up passes few entries.
BLOCK = 128


@lru_cache(maxsize=None)
def _blocks(transliterate: bool) -> str:
    several = _fold_tables(transliterate)[2]
    tables: list[dict] = [{} for _ in range(max(map(ord, several)) // BLOCK + 1)]
    for ch, text in several.items():
        tables[ord(ch) // BLOCK][ch] = text
    return json.dumps(tables)


def _spelled(ch: Column, transliterate: bool) -> Column:
    """One character, spelled out."""
    cp = F.ascii(ch)
    tables = F.from_json(F.lit(_blocks(transliterate)), "array<map<string,string>>")
    known = F.try_element_at(F.try_element_at(tables, (F.floor(cp / BLOCK) + 1).cast("int")), ch)
    if not transliterate:
        return F.when(ch < "\x80", ch).otherwise(F.coalesce(known, F.lit("")))
    at = cp - HANGUL[0]
    lead, vowel, tail = (F.array(*map(F.lit, part)) for part in hangul_parts())
    pick = lambda part, k: F.element_at(part, (F.floor(k) + 1).cast("int"))
    hangul = F.concat(pick(lead, at / 588), pick(vowel, at % 588 / 28), pick(tail, at % 28))
    rest = F.when(ch.rlike(r"^[\p{L}\p{N}]"), F.concat(F.lit("u"), F.lower(F.hex(cp)))).otherwise("")
    return (F.when(ch < "\x80", ch).when(cp.between(*HANGUL), hangul).when(cp.between(0x3400, 0x9FFF), rest).otherwise(F.coalesce(known, rest)))


NON_ASCII = r"[^\x00-\x7F]"
# Characters with several letters that are common in names: replaced literally before the slower spelling-out.
COMMON = ("ß", "æ", "Æ", "œ", "Œ")


def ascii_fold(c: Column, transliterate: bool = False) -> Column:
    """Accent-fold to ASCII; anything still non-ASCII is removed, but with ``transliterate`` no letter is: where no table or
    rule (``spell_out``) has it, it becomes its code point, so that different names keep different keys.

    ASCII rows pass unchanged.  In the others one ``translate`` handles every
    one-letter fold; rows with a character that becomes several letters are
    spelled out character by character."""
    src, dst, several = _fold_tables(transliterate)
    t = F.translate(c, src, dst)
    u = t
    for ch in COMMON:
        if ch in several:
            u = F.replace(u, F.lit(ch), F.lit(several[ch]))
    spelled = F.array_join(F.transform(F.split(u, ""), lambda ch: _spelled(ch, transliterate)), "")
    if not transliterate:
        # a character that becomes several letters is there if deleting them all shortens the text
        holds = F.length(F.translate(u, "".join(several), "")) != F.length(u)
        spelled = F.when(holds, spelled).otherwise(F.regexp_replace(u, NON_ASCII, ""))
    rest = F.when(u.rlike(NON_ASCII), spelled).otherwise(u)
    return F.when(c.rlike(NON_ASCII), F.when(t.rlike(NON_ASCII), rest).otherwise(t)).otherwise(c)


WHITESPACE = " \t\n\r\f\u000b"


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace of any kind (plain ``trim`` only removes
    spaces); touches only the ends of the string, unlike a regex."""
    return F.trim(F.col(c) if isinstance(c, str) else c, F.lit(WHITESPACE))


# F1 ----------------------------------------------------------------------------
def entity_key(c) -> Column:
    """Join key, ASCII form: "Last, First" -> "First Last" (first comma), fold
    accents, punctuation -> space, collapse spaces, drop one trailing
    upper-case roman-numeral token, trim.  Case is kept."""
    s = strip_ws(c)
    pos = F.instr(s, ",")
    after = s.substr(pos + F.lit(1), F.lit(1 << 30))
    before = s.substr(F.lit(1), pos - F.lit(1))
    swapped = F.concat_ws(" ", strip_ws(after), strip_ws(before))
    s = F.when(F.instr(s, ",") > 0, swapped).otherwise(s)
    s = ascii_fold(s)
    # punctuation -> space then collapse whitespace == each run of non-word
    # characters -> one space (the text is ASCII here): one pass instead of two
    s = F.regexp_replace(s, r"[^\w]+", " ")
    return strip_ws(drop_trailing_roman(s))


def drop_trailing_roman(s: Column) -> Column:
    """Remove a final run of I/V/X letters that starts a word (the pattern
    ``\\b[IVX]+$``) by trimming those letters off the end and keeping the cut
    only when a non-word character (or nothing) precedes it: the work is at
    the end of the string, not a scan of the whole text."""
    t = F.rtrim(s, F.lit("IVX"))
    boundary = (F.length(t) == 0) | F.substring(t, -1, 1).rlike(r"^\W$")
    return F.when((t != s) & boundary, t).otherwise(s)


# F2 ----------------------------------------------------------------------------
# Generational suffixes, dropped as whole words.
SUFFIX_WORDS = ("jr", "sr", "ii", "iii", "iv", "v")
SUFFIXES = r"\b(?:" + "|".join(SUFFIX_WORDS) + r")\b"
# What stands in one pair of parentheses on a line.
PARENTHETICAL = r"\([^)\n]*\)"


def folded_key(c) -> Column:
    """Join key, folded form: drop parentheticals, transliterate, unify
    apostrophes, lower-case, drop generational suffixes, punctuation -> space,
    collapse and trim; NULL -> ''."""
    s = F.col(c) if isinstance(c, str) else c
    s = F.regexp_replace(s, PARENTHETICAL, " ")
    s = ascii_fold(s, transliterate=True)
    s = F.lower(s)
    s = F.regexp_replace(s, SUFFIXES, " ")
    s = strip_ws(F.regexp_replace(s, r"[^\w]+", " "))
    return F.coalesce(s, F.lit(""))


# F3 ----------------------------------------------------------------------------
# Canonical status labels, matched by case-insensitive prefix.
CANONICAL_STATUS = ("Out", "Doubtful", "Questionable", "Probable", "Available", "Inactive",
                    "Day-To-Day", "Two-Way", "Ineligible", "Return To Competition Reconditioning")


def status_reason(c) -> tuple[Column, Column]:
    """Split "Status (Reason) - note" into a canonical status and the reason.

    The status is the leading run of letters, spaces and hyphens up to the
    first "(", " - " or end of text (title-cased, then mapped to the canonical
    label it starts with); the reason is the first parenthesis.  The label is
    found with one anchored alternation and a map lookup, so each row runs a
    fixed handful of regexes rather than one per label.
    """
    s = F.trim(F.col(c) if isinstance(c, str) else c)
    raw = F.trim(F.regexp_extract(s, r"^([A-Za-z][A-Za-z\- ]*?)\s*(?:\(|\s-\s|$)", 1))
    labels = "|".join(re.escape(x.lower()) for x in CANONICAL_STATUS)
    hit = F.regexp_extract(F.lower(raw), f"^({labels})", 1)
    canon = F.create_map(*[F.lit(x) for lab in CANONICAL_STATUS for x in (lab.lower(), lab)])[hit]
    status = F.when(raw != "", F.coalesce(canon, title_case(raw)))
    reason = F.trim(F.regexp_extract(s, r"\(([^)]+)\)", 1))
    return status, F.when(reason != "", reason)


# F10 ---------------------------------------------------------------------------
def signed_number(c) -> Column:
    """'+7' -> 7.0, '-3' -> -3.0, 'None'/junk -> NULL."""
    s = F.regexp_replace(F.trim(F.col(c) if isinstance(c, str) else c), r"^\+", "")
    return s.try_cast("double")


# F11 ---------------------------------------------------------------------------
def squish(c) -> Column:
    return F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\s+", " "))


def strip_tags(c) -> Column:
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"<[^>]*>", "")


def count_substring(c, text: str) -> Column:
    """How often the literal text occurs, without overlap."""
    return F.regexp_count(F.col(c) if isinstance(c, str) else c, F.lit(re.escape(text)))


def title_case(c) -> Column:
    """Capitalise every letter run (also after '-'), lower-case the rest."""
    s = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.initcap(F.regexp_replace(s, "-", "- ")), "- ", "-")


def sentence_case(c) -> Column:
    s = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


# F12 ---------------------------------------------------------------------------
def id_list(c, sep: str = "-") -> Column:
    """'3-1-2' -> [1, 2, 3] (numeric sort)."""
    return F.array_sort(F.transform(F.split(F.col(c) if isinstance(c, str) else c, sep),
                                    lambda x: x.cast("long")))


def join_ids(c, sep: str = "-") -> Column:
    return F.array_join(F.transform(F.array_sort(F.col(c) if isinstance(c, str) else c),
                                    lambda x: x.cast("string")), sep)


# F13 ---------------------------------------------------------------------------
def recode(c, mapping: dict, default=None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    fallback = col if default is None else F.lit(default)
    return F.coalesce(m[col], fallback)
