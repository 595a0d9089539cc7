"""Text columns: trimming, redaction, question cleaning, escaping, answers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry import fixed_values as V


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every Unicode white-space character (``trim`` knows spaces only)."""
    return F.btrim(col(c), F.lit(V.SPACE_CHARS))


def head(c: Column | str, chars: int) -> Column:
    return F.substring(col(c), 1, chars)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` names it."""
    return F.transform(F.array(c), use)[0]


def _may_match(c: Column) -> list[Column]:
    """Per secret rule: a plain substring test that no match can fail.

    Matching text has a rule's word in it, but for the three letters that fold
    to ``s`` and ``i`` in a pattern and not in ``lower``. The word in what a rule has put
    there is none: a bracket follows it, and no match reaches over one.
    """
    lowered = F.replace(F.lower(c), F.lit(V.SECRET_RULES[0][1].lower()), F.lit(" "))
    # Lowered once, not for every word.
    word = bound(lowered, lambda low: reduce(or_, [low.contains(word) for word in V.SECRET_WORDS]))
    folded = [c.contains(letter) for letter in V.ODD_FOLDING]
    assigned = c.contains("=") | c.contains(":")
    return [assigned & reduce(or_, [word, *folded])] + [c.contains(x) for x in V.KEY_PREFIXES]


def redact_secrets(c: Column | str) -> Column:
    """Replace what looks like a secret, rule after rule.

    The patterns run only where a substring test on the untouched text allows a
    match; a replacement never makes one for a later rule.
    """

    def rules(given: Column) -> Column:
        return reduce(
            lambda done, step: F.when(step[0], F.regexp_replace(done, *step[1])).otherwise(done),
            zip(_may_match(given), V.SECRET_RULES),
            given,
        )

    return bound(col(c), rules)


def secret_hits(c: Column | str) -> Column:
    """How many matches of each rule the untouched text holds, in rule order."""
    return bound(
        col(c),
        lambda given: F.array(*[
            F.when(likely, F.regexp_count(given, F.lit(pattern))).otherwise(0)
            for likely, (pattern, _) in zip(_may_match(given), V.SECRET_RULES)
        ]),
    )


def _replace_markers(c: Column, by: str) -> Column:
    # One pass per marker, so a marker that forms out of a removal stays.
    return reduce(
        lambda done, marker: F.regexp_replace(done, "(?iu)" + _literal(marker), by),
        V.INSTRUCTION_MARKERS,
        c,
    )


def clean_question(c: Column | str, max_chars: int | None = None) -> Column:
    """Stripped, without instruction markers; cut only where a length is given."""
    whole = strip(c)
    return strip(_replace_markers(whole if max_chars is None else head(whole, max_chars), ""))


def question_reject(c: Column | str, max_chars: int | None = None) -> Column:
    """Why a question is not asked; null for those that are."""
    reason = F.when(F.coalesce(F.length(col(c)), F.lit(0)) == 0, "empty")
    return reason if max_chars is None else reason.when(F.length(col(c)) > max_chars, "too long")


def valid_question(c: Column | str, max_chars: int | None = None) -> Column:
    return question_reject(c, max_chars).isNull()


def escape_html(c: Column | str) -> Column:
    """Escape ``& < >``; quotes stay."""
    escaped = F.replace(col(c), F.lit("&"), F.lit("&amp;"))
    escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
    return F.replace(escaped, F.lit(">"), F.lit("&gt;"))


def safe_output(c: Column | str) -> Column:
    return escape_html(redact_secrets(c))


def wrap_untrusted(c: Column | str) -> Column:
    inner = _replace_markers(redact_secrets(c), "[filtered]")
    return F.concat(F.lit(V.UNTRUSTED_OPEN), inner, F.lit(V.UNTRUSTED_CLOSE))


def diagram_label(c: Column | str) -> Column:
    return head(F.translate(col(c), " -", "__"), V.LABEL_CHARS)


def title_word(c: Column | str) -> Column:
    return F.initcap(col(c))


def setting_values(c: Column | str) -> Column:
    """Comma list → distinct trimmed lower-case values, blanks dropped."""
    values = F.transform(F.split(col(c), ","), lambda x: F.lower(strip(x)))
    return F.array_distinct(F.filter(values, lambda x: x != ""))


def newline_count(c: Column | str) -> Column:
    return F.length(col(c)) - F.length(F.replace(col(c), F.lit("\n"), F.lit("")))


def shown(c: Column | str, chars: int | None) -> Column:
    return col(c) if chars is None else head(c, chars)


def fenced(c: Column | str) -> Column:
    return F.concat(F.lit("```python\n"), col(c), F.lit("\n```"))


def hit_block(kind: Column, name: Column, path: Column, line: Column, body: Column) -> Column:
    """Context block of one search hit."""
    heading = F.concat(
        F.lit("### "), kind, F.lit(": `"), name, F.lit("` — "), path, F.lit(" (line "),
        F.coalesce(line.cast("string"), F.lit("None")), F.lit(")\n"),
    )
    return F.concat(heading, fenced(body))


def summary_block(name: Column, path: Column, body: Column, chars: int | None = V.SUMMARY_CHARS) -> Column:
    heading = F.concat(F.lit("### "), name, F.lit(" ("), path, F.lit(")\n"))
    return F.concat(heading, fenced(shown(body, chars)))


def entity_line(kind: Column, name: Column, path: Column) -> Column:
    return F.concat(F.lit("- "), kind, F.lit(": `"), name, F.lit("` in `"), path, F.lit("`"))


def offline_answer(
    context: Column | str, question: Column | str, snippets: int | None = V.ANSWER_SNIPPETS,
    chars: int | None = V.ANSWER_CHARS,
) -> Column:
    """Numbered snippets of a context, as shown where no model answers; None is all of them, and whole."""
    pieces = F.filter(
        F.transform(F.split(col(context), "```", -1), strip), lambda piece: piece != ""
    )
    numbered = F.transform(
        pieces if snippets is None else F.slice(pieces, 1, snippets),
        lambda piece, i: F.concat(
            (i + 1).cast("string"), F.lit(". "), shown(piece, chars), F.lit("...\n")
        ),
    )
    opening = F.array(
        F.concat(F.lit(V.OFFLINE_QUESTION), col(question), F.lit("\n")), F.lit(V.OFFLINE_CONTEXT)
    )
    return F.array_join(F.concat(opening, numbered), "\n")
