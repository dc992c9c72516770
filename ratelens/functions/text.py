"""Column expressions for review text: trimming, stop-word removal,
punctuation stripping, tokenising. All JVM-side built-ins (no UDF)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# The default stop-word pattern (one regex; alternation is tried left to
# right, so a shorter word listed earlier wins over a longer phrase).
STOPWORD_PATTERN = (
    r"\b(là|của|và|có|được|bị|đã|đang|sẽ|từng|cũng|vẫn|còn|lại|rất|khá|hơi|quá|tôi|ta|tao|mày|bạn|anh|chị|em|ông|bà|họ|chúng|chúng tôi|chúng ta|chúng nó|nó|một|hai|ba|vài|nhiều|ít|mọi|mỗi|từng|các|những|cái|này|kia|đó|ấy|trong|ngoài|trên|dưới|giữa|bên|cạnh|với|theo|cho|về|từ|đến|tại|bởi|vì|do|nên|nếu|thì|mà|nhưng|hoặc|ai|gì|nào|sao|tại sao|bao giờ|bao lâu|bao nhiêu|đâu|chăng|à|ư|hả|nhỉ|nhé|có thể|cần|phải|nên|muốn|định|đang|được|bị|hôm nay|hôm qua|ngày|tháng|năm|lúc|khi|trước|sau|rồi|đã từng|ạ|à|ừ|ừm|nhé|nha|nhỉ|đấy|đó|thôi|cơ|mà|chứ|làm|đi|đến|ra|vào|ở|nói|biết|thấy|nghĩ)\b"
)
# Tokeniser separators: space, double quote, comma, parentheses, asterisk
# (tab and newline are not separators).
TOKEN_SEPARATORS = r'[ ",()*]'
# Characters kept by the symbol strip: ASCII letters, digits and U+00E0..U+1EF9.
KEEP_WORD_CHARS = r"[^a-zA-Zà-ỹ0-9]"
# ASCII punctuation class; runs of two or more whitespace characters.
PUNCT_CLASS = r"[\p{Punct}]"
MULTI_SPACE = r"\s{2,}"
# ---------------------------------------------------------------------------

# Leading/trailing characters <= U+0020, as Java's String.trim removes them
# (Spark's one-argument trim removes spaces only).
_EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+$"
_JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Strip every character <= U+0020 from both ends (no regex: Spark's
    two-argument trim removes any of the given characters)."""
    return F.trim(_col(c), F.lit(_JAVA_TRIM_CHARS))


_WORD_LIST = re.compile(r"\\b\(([^()\[\]{}.*+?^$\\|]+(?:\|[^()\[\]{}.*+?^$\\|]+)*)\)\\b")


def grouped_alternation(pattern: str) -> str:
    """Same matches as a ``\\b(w1|w2|...)\\b`` word-list pattern, faster.

    Alternatives are grouped by first character, keeping their original
    order inside each group. Alternatives with different first characters
    can never match at the same position, so the regex engine still tries
    every possible alternative in the original order (leftmost-first
    semantics, including backtracking on the closing ``\\b``) while
    skipping the ones that cannot start there. Any other pattern is
    returned unchanged."""
    m = _WORD_LIST.fullmatch(pattern)
    if not m:
        return pattern
    groups: dict[str, list[str]] = {}
    for w in m.group(1).split("|"):
        groups.setdefault(w[0], []).append(w[1:])
    body = "|".join(first + "(?:" + "|".join(rests) + ")" for first, rests in groups.items())
    return r"\b(?:" + body + r")\b"


def remove_pattern(c, pattern: str | Column = STOPWORD_PATTERN) -> Column:
    """Delete every match of ``pattern``. ``\\b`` is made Unicode-aware with
    ``(?U)`` so boundaries next to accented letters behave on every JDK."""
    if isinstance(pattern, Column):
        return F.regexp_replace(_col(c), F.concat(F.lit("(?U)"), pattern), F.lit(""))
    return F.regexp_replace(_col(c), "(?U)" + grouped_alternation(pattern), "")


def live_phrases(pattern: str) -> list[str] | None:
    """The alternatives of a word-list pattern that hold a space and can match:
    one whose first word stands alone earlier in the list never does. None for
    a pattern that is no list of plain words and phrases."""
    m = _WORD_LIST.fullmatch(pattern)
    if not m:
        return None
    words = m.group(1).split("|")
    if not all(part.isalnum() for w in words for part in w.split(" ")):
        return None
    return [w for i, w in enumerate(words) if " " in w and w.split(" ")[0] not in words[:i]]


# Where a raw token ends: space and ASCII punctuation, except the underscore, which is a word character.
_RAW_BREAK = r"[ -/:-@\[-\^`{-~]"


def raw_tokens(c, pattern: str = STOPWORD_PATTERN) -> Column:
    """The pieces of a lower-cased text between spaces and ASCII punctuation.

    Cleaning the text and splitting it gives the same words as cleaning each
    piece and splitting that: a single stop word never spans a break, a break
    is no word character (so ``\\b`` at a piece's edge answers as it does in
    the text), and it becomes a space. Only a phrase spans one; phrases are taken
    out first, in texts that hold the first word of one. ``pattern`` must be
    a word list (``live_phrases`` not None)."""
    text = F.lower(_col(c))
    phrases = live_phrases(pattern)
    if phrases:
        firsts = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w + " ")) for w in dict.fromkeys(p.split(" ")[0] for p in phrases)])
        without = F.regexp_replace(text, "(?U)" + grouped_alternation(r"\b(" + "|".join(phrases) + r")\b"), "")
        text = F.when(firsts, without).otherwise(text)
    return F.split(text, _RAW_BREAK)


def punct_to_space(c) -> Column:
    return F.regexp_replace(_col(c), PUNCT_CLASS, " ")


def collapse_spaces(c) -> Column:
    return F.regexp_replace(_col(c), MULTI_SPACE, " ")


def clean_review(c, pattern: str | Column = STOPWORD_PATTERN) -> Column:
    """lower -> drop stop words -> punctuation to space -> collapse -> trim."""
    return java_trim(collapse_spaces(punct_to_space(remove_pattern(F.lower(_col(c)), pattern))))


def tokens(c) -> Column:
    """Array of non-empty tokens; NULL text gives NULL (explodes to no row)."""
    return F.filter(F.split(_col(c), TOKEN_SEPARATORS), lambda w: w != "")


def _class_ranges(body: str) -> list[tuple[int, int]]:
    """Code-point ranges of a plain class body such as 'a-zA-Z0-9 ",()*'."""
    out, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            out.append((ord(body[i]), ord(body[i + 2])))
            i += 3
        else:
            out.append((ord(body[i]), ord(body[i])))
            i += 1
    return out


def complement_class(body: str) -> str:
    """A positive class matching exactly what ``[^body]`` matches.

    Java's regex engine evaluates a negated class an order of magnitude
    slower than a positive one over long texts; the complement ranges
    (up to U+10FFFF) select the same characters."""
    gaps, nxt = [], 0
    for lo, hi in sorted(_class_ranges(body)):
        if lo > nxt:
            gaps.append((nxt, lo - 1))
        nxt = max(nxt, hi + 1)
    if nxt <= 0x10FFFF:
        gaps.append((nxt, 0x10FFFF))
    return "[" + "".join(f"\\x{{{lo:X}}}" + (f"-\\x{{{hi:X}}}" if hi > lo else "") for lo, hi in gaps) + "]"


_KEEP_BODY = KEEP_WORD_CHARS[2:-1]
_SEPARATOR_BODY = TOKEN_SEPARATORS[1:-1]
_NOT_KEPT = complement_class(_KEEP_BODY)
_NOT_KEPT_NOR_SEPARATOR = complement_class(_KEEP_BODY + _SEPARATOR_BODY)


def strip_symbols(c) -> Column:
    """Remove every character outside ``KEEP_WORD_CHARS``'s kept set."""
    return F.regexp_replace(_col(c), _NOT_KEPT, "")


def strip_symbols_keep_separators(c) -> Column:
    """``strip_symbols`` over a whole text, keeping the token separators.

    Tokenising the result gives, token by token, exactly the stripped
    tokens of the original text (a token never spans a separator), with one
    regex pass per text instead of one per token."""
    return F.regexp_replace(_col(c), _NOT_KEPT_NOR_SEPARATOR, "")


def full_match(c, regex: str) -> Column:
    """Whole-string regex match (``rlike`` alone is a partial match)."""
    return _col(c).rlike("^(?:" + regex + ")$")


def extract_or_null(c, regex: str, group: int) -> Column:
    """Group ``group`` of ``regex``, NULL when the line does not match
    (``regexp_extract`` alone returns '' on no match)."""
    return F.when(_col(c).rlike(regex), F.regexp_extract(_col(c), regex, group))


def loose_long(c) -> Column:
    """String to bigint; a decimal string is truncated ('12.5' -> 12), junk -> NULL."""
    c = _col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


NULL_FIELD = r"\N"


def escape_field(c) -> Column:
    """A value as one field of a tab-separated line: backslash, tab and line
    breaks as two characters each, NULL as ``\\N``."""
    out = _col(c).cast("string")
    for char, code in (("\\", r"\\"), ("\t", r"\t"), ("\n", r"\n"), ("\r", r"\r")):
        out = F.replace(out, F.lit(char), F.lit(code))
    return F.coalesce(out, F.lit(NULL_FIELD))


def unescape_field(c) -> Column:
    """The value that ``escape_field`` wrote. Cut at the escaped backslashes first:
    any other backslash then starts a code."""
    def plain(part: Column) -> Column:
        for char, code in (("\t", r"\t"), ("\n", r"\n"), ("\r", r"\r")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part
    c = _col(c)
    return F.when(c != NULL_FIELD, F.array_join(F.transform(F.split(c, r"\\\\"), plain), "\\"))
