"""Line-first cleaning: rules judge lines, failing lines go, documents that lose too much text go.

Defined cases: null and empty texts have no words and fail; repeated rows are judged one by one; other columns of the
input are kept as they are, and a column of the input named like a result column is replaced by the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from telescry.llm.common import WORD, map_rows, text_of

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
_SEPARATOR = re.compile(r"(?:^|[\x20\t])(?:\||>|<|»|«|·|•|/|::)(?=[\x20\t]|$)")
_BOILERPLATE = re.compile(
    r"\b(?:all rights reserved|privacy policy|terms of (?:use|service)|accept (?:all )?cookies|cookie (?:policy|settings)|"
    r"enable javascript|sign (?:in|up)|log ?in|subscribe (?:now|to our)|click here|read more|share on|follow us|skip to (?:main )?content)\b",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; shares are of the words of a line."""

    symbol_share: float = 0.25  # symbols per word
    separator_share: float = 0.2  # menu separators standing as words
    shout_share: float = 0.5  # words ending in two or more exclamation or question marks
    echo_share: float = 0.5  # words equal to the word before
    least_words: int = 8  # of a line that the share of shouts and echoes judges
    boilerplate_words: int = 12  # a navigation phrase fails only lines of at most so many words
    lost_share: float = 0.4  # characters of words lost, beyond which the document goes


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_lines_removed long, lost_chars long, kept boolean, clean_text string"
)


def line_failure(line: str, words: list[str], rules: LineRules) -> str | None:
    """The first rule that a line with words fails, or None."""
    n = len(words)
    if len(_SYMBOL.findall(line)) > rules.symbol_share * n and n >= 3:
        return "punctuation"
    if (k := len(_SEPARATOR.findall(line))) >= 3 and k > rules.separator_share * n:
        return "navigation"
    if n <= rules.boilerplate_words and _BOILERPLATE.search(line):
        return "boilerplate"
    if n >= rules.least_words:
        if sum(w.endswith(("!!", "??", "?!", "!?")) for w in words) > rules.shout_share * n:
            return "punctuation"
        if sum(map(str.__eq__, words, words[1:])) > rules.echo_share * n:
            return "repetition"
    return None


def repeated_words(words: list[str], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    code = ids[: n - width + 1]
    for k in range(1, width):  # codes stay below n, so that the product fits 64 bits
        code = np.unique(code * len(number) + ids[k : n - width + 1 + k], return_inverse=True)[1].reshape(-1)
    twice = (np.bincount(code) > 1)[code]
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= twice
    return int(covered.sum())


def judge(text: str, rules: LineRules = LineRules()) -> dict:
    """All result columns of one text."""
    words: list[str] = []
    kept, seen = [], set()
    dup = removed = lost = 0
    for line in text.split("\n"):
        own = _WORD.findall(line)
        if not own:
            kept.append(line)
            continue
        words += own
        dup += line in seen
        seen.add(line)
        if line_failure(line, own, rules):
            removed += 1
            lost += sum(map(len, own))
        else:
            kept.append(line)
    n, chars, repeat = len(words), sum(map(len, words)), repeated_words(words)
    failed = n < 50 or 100 * repeat > 50 * n
    return {
        "n_words": n, "word_chars": chars, "n_symbols": len(_SYMBOL.findall(text)), "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed,
        "n_lines_removed": removed, "lost_chars": lost, "kept": not failed and lost <= rules.lost_share * chars, "clean_text": "\n".join(kept),
    }


def clean_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the result columns: base counts, lines removed, the verdict and the text that is left."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    keep = [c for c in docs.columns if c not in names]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [RESULT])

    def rows(batch):
        judged = [judge(x or "", rules) for x in batch["text"]]
        yield {c: batch[c] for c in keep} | {c: [j[c] for j in judged] for c in names}

    return map_rows(docs.select(*keep), schema, rows)


def verdicts(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """doc_id with the counts and the verdict, without texts."""
    return clean_lines(docs.select("doc_id", text_of().alias("text")), rules).drop("text", "clean_text")
