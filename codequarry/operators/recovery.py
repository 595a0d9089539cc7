"""Per-file helper: readable copies of a source text that the parser refuses.

A text is cut into its top-level statements, lines from one that starts at the margin to
the next, and each is parsed by itself, so an error stays inside its statement. There,
the lines that the parser complains of are covered, one after the other, until it reads
the rest: a broken statement by a name of the same length, a broken heading by a plain
one of the same kind, so that what it heads stays in place. Covers keep line numbers and
columns, hence all facts are read off the original text.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator
from typing import NamedTuple

UNREADABLE = (SyntaxError, ValueError, RecursionError, MemoryError)

# A statement of which more lines than this, and more than half, are refused is not read.
NO_CODE_LINES = 64

_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")
# Starts of lines whose first character is no white space; without and with carriage returns.
_MARGIN = re.compile(r"^(?=\S)", re.MULTILINE)
_ANY_MARGIN = re.compile(r"(?:\A|(?<=\n)|(?<=\r)(?!\n))(?=\S)")
_QUOTES = re.compile(r"""#[^\r\n]*|\"\"\"|'''|"(?:[^"\\\r\n]|\\.)*"|'(?:[^'\\\r\n]|\\.)*'|[()\[\]{}]""", re.DOTALL)
# A line at the margin that goes on with the statement before it.
_GOES_ON = re.compile(r"(?:else|elif|except|finally)\b|[)\]}#]")
_STARTS = re.compile(r"(?:def|class|import|async\s+def|from\s+[\w.]+\s+import)\b|@\w")
# A line that no bracket can hold.
_NOT_INSIDE = re.compile(
    r"[ \t]*(?:@|(?:def|class|return|while|with|try|raise|import|pass|break|continue|del|global|nonlocal|assert)\b)")
# Line ends and characters of which the parser and line counts could think differently, and lines of a backslash alone.
_ODD_CHARACTERS = re.compile(r"[\r\f\0]|^[ \t]*\\$", re.MULTILINE)
_NAMED = re.compile(r"\b(?:def|class|import)\b")
_HEADING = re.compile(r"(?P<indent>[ \t]*)(?P<kind>async\s+def|def|class|except|finally|else|elif|[a-z]+)\b\s*(?P<name>\w*)")
_OLD_CALL = re.compile(r"[ \t]*(?:print|exec)\b(?!\s*[(=.\[:,)])")


class Piece(NamedTuple):
    """A top-level statement: its text, the lines before it, its tree and the lines not read, with the reason.

    Or ``several``, none of them with errors.
    """

    text: str
    lines_before: int
    tree: ast.Module | None
    errors: list[tuple[int, int, str]]
    several: bool = False


def _starts(text: str, bracketed: bool = True) -> list[int]:
    """Character offsets of top-level statements, found in one pass over quotes and brackets.

    Without ``bracketed`` a line at the margin starts one also where a bracket is open.
    """
    # Only lines that start at the margin can start a statement.
    lines = [m.start() for m in (_ANY_MARGIN if "\r" in text else _MARGIN).finditer(text)]
    out, depth, at, decorated = [0], 0, 0, False
    if not lines or lines[-1] == 0:
        return out
    tokens = _QUOTES.finditer(text)
    token = next(tokens, None)
    open_quote = {}
    for start in [*lines, len(text)]:
        # Quotes and brackets that begin before this line, outside what is quoted already.
        while token is not None and token.start() < start:
            found, begin = token.group(), token.start()
            token = next(tokens, None)
            if begin < at:
                continue
            if found in "([{":
                depth += bracketed
            elif found in ")]}":
                depth = max(0, depth - 1)
            elif found in ('"""', "'''"):
                if found not in open_quote or open_quote[found] >= 0:
                    open_quote[found] = text.find(found, begin + 3)
                if open_quote[found] >= 0:
                    at = open_quote[found] + 3
                    tokens = _QUOTES.finditer(text, at)
                    token = next(tokens, None)
        if at <= start < len(text):
            if depth and _STARTS.match(text, start):
                depth = 0  # a bracket that was never closed
            if depth == 0 and not _GOES_ON.match(text, start):
                if not decorated and start:
                    out.append(start)
                decorated = text[start] == "@"
    return out


class _Cover:
    """The lines of one statement, covered step by step: 0 as it is, 1 and 2 ever plainer, 3 empty."""

    def __init__(self, text: str):
        self.lines = _LINE.findall(text)
        self.shown = list(self.lines)
        self.level = [0] * len(self.lines)
        self.first: dict[int, str] = {}
        self.last, self.streak = -2, 0

    def text(self) -> str:
        return "".join(self.shown)

    def _show(self, i: int, body: str, level: int, reason: str) -> None:
        line = self.lines[i]
        ending = line[len(line.rstrip("\r\n")):]
        self.shown[i], self.level[i] = body + ending, level
        self.first.setdefault(i, reason)

    def cover(self, i: int, reason: str) -> bool:
        """Cover line ``i`` one step more; False if there is nothing left of it.

        Where line after line is refused, this is no code: ever more of the lines behind
        are covered at once, up to one that could name something, and beyond it too
        after a dozen.
        """
        if not self._cover(i, reason):
            return False
        if i not in (self.last, self.last + 1):
            self.streak = 0
        self.streak += i == self.last + 1
        self.last = i
        if self.streak > 3:
            for k in range(i + 1, min(i + (1 << (self.streak - 3)), len(self.lines))):
                if self.streak < 12 and _STARTS.match(self.lines[k].lstrip()):
                    break
                self.level[k] = max(self.level[k], 2)
                self._cover(k, reason)
                self.last = k
        return True

    def _cover(self, i: int, reason: str) -> bool:
        body = self.lines[i].rstrip("\r\n")
        inner = body.strip()
        if self.level[i] >= 3 or not inner:
            return False
        indent = body[:len(body) - len(body.lstrip())]
        heading = _HEADING.match(body)
        if self.level[i] == 0 and heading and (inner.endswith(":") or heading["kind"] in ("def", "class")):
            self._show(i, indent + _plain(heading), 1, reason)
        elif self.level[i] < 2:
            # Of the same length in bytes, so that what ends here ends where it did.
            self._show(i, indent + "_" * len(inner.encode("utf-8", "replace")), 2, reason)
        else:
            self._show(i, "#", 3, reason)
        return True

    def open(self, i: int, reason: str) -> None:
        """Make a covered line head the deeper lines behind it."""
        body = self.lines[i]
        self._show(i, body[:len(body) - len(body.lstrip())] + "if 1:", 2, reason)

    def open_bracket(self, i: int) -> int:
        """The line of the last bracket still open where line ``i`` starts; else ``i``."""
        before = "".join(self.shown[:i])
        held = []
        for token in _QUOTES.finditer(before):
            if token.group() in "([{":
                held.append(token.start())
            elif token.group() in ")]}" and held:
                held.pop()
        if not held:
            return i
        return len(_LINE.findall(before[:held[-1] + 1])) - 1

    def above(self, i: int) -> int | None:
        """The nearest line before ``i`` that still shows something."""
        for k in range(i - 1, -1, -1):
            if self.level[k] < 3 and self.shown[k].strip():
                return k
        return None

    def spans(self, before: int) -> list[tuple[int, int, str]]:
        """(first line, last line, reason) of covered lines next to each other."""
        out: list[tuple[int, int, str]] = []
        for i in sorted(self.first):
            if out and out[-1][1] == before + i:
                out[-1] = (out[-1][0], before + i + 1, out[-1][2])
            else:
                out.append((before + i + 1, before + i + 1, self.first[i]))
        return out


def _plain(heading: re.Match) -> str:
    kind, name = heading["kind"], heading["name"]
    if kind.endswith("def") and name.isidentifier():
        return f"{kind} {name}():"
    if kind == "class" and name.isidentifier():
        return f"class {name}:"
    return {"except": "except:", "finally": "finally:", "else": "else:", "elif": "elif 1:"}.get(kind, "if 1:")


def _step(cover: _Cover, error: SyntaxError) -> bool:
    """Cover what the parser complains of; False if that changes nothing."""
    reason, said = type(error).__name__, error.msg or ""
    last = len(cover.lines) - 1
    at = min(max((error.lineno or 1) - 1, 0), last)
    if said.startswith("Missing parentheses in call to"):
        old = [i for i, line in enumerate(cover.lines) if cover.level[i] == 0 and _OLD_CALL.match(line)]
        if old and all([cover.cover(i, reason) for i in old]):
            return True
    named = re.search(r"on line (\d+)", said)
    if "expected an indented block" in said and named and cover.cover(int(named[1]) - 1, reason):
        return True
    if "expected 'except' or 'finally' block" in said:
        depth = len(cover.shown[at]) - len(cover.shown[at].lstrip())
        for i in range(at, -1, -1):
            line = cover.shown[i]
            if line.lstrip().startswith("try") and len(line) - len(line.lstrip()) <= depth and cover.level[i] < 2:
                cover.open(i, reason)
                return True
    if said == "unexpected indent":
        head = cover.above(at)
        if head is not None and cover.level[head] and not cover.shown[head].rstrip().endswith(":"):
            cover.open(head, reason)
            return True
        cover.level[at] = max(cover.level[at], 2)
        return cover.cover(at, reason)
    if isinstance(error, IndentationError) or "inconsistent use of tabs" in said:
        cover.level[at] = max(cover.level[at], 2)
    if _NOT_INSIDE.match(cover.shown[at]):
        at = cover.open_bracket(at)
    if "does not match opening parenthesis" in said and named:
        at = int(named[1]) - 1
    while at is not None and not cover.cover(at, reason):
        at = cover.above(at)
    return at is not None


def _parsed(text: str, before: int, failed: Exception | None = None) -> Piece:
    """A statement as far as it can be read; ``failed`` is how the parser refused it as it is."""
    cover = _Cover(text.replace("\0", " "))
    if "\0" in text:
        for i, line in enumerate(_LINE.findall(text)):
            if "\0" in line:
                cover.first[i] = "SyntaxError"
    while True:
        try:
            if failed is not None:
                refusal, failed = failed, None
                raise refusal
            return Piece(text, before, ast.parse(cover.text()), cover.spans(before))
        except SyntaxError as error:
            # What names nothing has no facts, whatever else is wrong with it; and where
            # the parser refuses most lines, this is no code.
            refused = len(cover.first) > NO_CODE_LINES and 2 * len(cover.first) > (error.lineno or 1)
            if refused or not _NAMED.search(text) or not _step(cover, error):
                return Piece(text, before, None, [(before + 1, before + max(1, len(cover.lines)), type(error).__name__)])
        except UNREADABLE as error:
            return Piece(text, before, None, [(before + 1, before + max(1, len(cover.lines)), type(error).__name__)])


def _balanced(text: str) -> bool:
    """Whether brackets outside quotes and comments are closed here, and quotes too."""
    depth, tokens = 0, _QUOTES.finditer(text)
    token = next(tokens, None)
    while token is not None:
        found = token.group()
        if found in "([{":
            depth += 1
        elif found in ")]}":
            depth -= 1
            if depth < 0:
                return False
        elif found in ('"""', "'''"):
            end = text.find(found, token.end())
            if end < 0:
                return False
            tokens = _QUOTES.finditer(text, end + 3)
        token = next(tokens, None)
    return depth == 0


def _before_error(parts: list[str], failed: Exception | None) -> tuple[list[str], ast.Module | None, SyntaxError | None]:
    """(the statements before the one in which the whole text was refused, their tree, what the parser says of that one).

    They are parsed together, if none of them reaches over into the next; and where the
    text behind the refused one cannot have a say, the parser is not asked about it again.
    """
    if not isinstance(failed, SyntaxError) or not failed.lineno:
        return [], None, None
    lines, n = 0, 0
    begins = []
    while n < len(parts) and lines + parts[n].count("\n") < failed.lineno:
        begins.append(lines + 1)
        lines += parts[n].count("\n")
        n += 1
    if n == len(parts):
        return [], None, None
    tree = None
    if n:
        try:
            tree = ast.parse("".join(parts[:n]))
        except UNREADABLE:
            return [], None, None
        at = 1
        for statement in tree.body:
            first = min([statement.lineno, *(d.lineno for d in getattr(statement, "decorator_list", ()))])
            while at < n and begins[at] <= first:
                at += 1
            if at < n and begins[at] <= statement.end_lineno:
                return [], None, None
    said = failed.msg or ""
    if " line " in said or not _balanced(parts[n]):
        return parts[:n], tree, None
    known = type(failed)(said)
    known.lineno = failed.lineno - lines
    return parts[:n], tree, known


def pieces(text: str, failed: Exception | None = None) -> Iterator[Piece]:
    """The statements of a text in order, each with as much of a tree as can be read.

    One that has errors is taken apart at each line at the margin first: the bracket that
    held them together may never have been closed. ``failed`` is how the parser refused the
    text as a whole.
    """
    before = 0
    parts, refused = _parts(text, _starts(text)), None
    if failed is not None and not _ODD_CHARACTERS.search(text):
        together, tree, refused = _before_error(parts, failed)
        if together:
            yield Piece("".join(together), 0, tree, [], True)
            parts = parts[len(together):]
            before = sum(part.count("\n") for part in together)
    for part in parts:
        try:
            if refused is not None:
                known, refused = refused, None
                raise known
            found = [Piece(part, before, ast.parse(part), [])]
        except UNREADABLE as error:
            found, at = [], before
            inner_parts = _parts(part, _starts(part, False))
            # Nothing to take apart: what the parser said of it holds.
            known = error if len(inner_parts) == 1 and "\0" not in part else None
            for inner in inner_parts:
                found.append(_parsed(inner, at, known))
                at += _lines(inner)
            known = None
        yield from found
        before += _lines(part)


def _parts(text: str, starts: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def _lines(text: str) -> int:
    return len(re.findall(r"\r\n|\r|\n", text)) if "\r" in text else text.count("\n")
