"""Sentences of a line of English text, by rule.

A line is read once.  First its list markers are found: a run of markers of one style that count on,
the first of them in front, makes each item a sentence.  Then each group of end marks is judged: by
its kind, by what stands before it (an abbreviation of some kind, an initial, a
time of day, a number) and by the word behind it.  Nothing is cut inside brackets, or inside
quotation marks before their end.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

#: Abbreviations in lower case, by what follows them.
TITLES = frozenset("mr mrs ms messrs dr prof gen col lt sgt capt cpt cmdr cdr adm maj brig cpl pvt sen rep gov pres hon rev fr st ste mt ft supt insp amb msgr sr_".split())
NUMBERED = frozenset("no nos p pp art arts vol vols fig figs sec secs ch chap ver eq eqs tab op ed § n°".split())
OTHERS = frozenset("co inc ltd corp bros llc plc jr sr esq phd md dept univ assn est ave blvd rd sq apt etc al approx jan feb mar apr jun jul aug sep sept oct nov dec mon tue tues wed thu thur thurs fri sat sun vt ok".split())
JOINING = frozenset("e.g i.e eg ie vs v cf viz ca incl esp".split())
#: Words that seldom go on with a name, so that a capital in them starts a sentence.
STARTERS = frozenset(
    "a an the this that these those he she it they we you i my your his her its our their there here who whom whose what when where why which how did do does is are was were has have had will would can could should may might must "
    "in on at by for from to of with without after before during while since until if unless because although though as but and or nor so yet then thus hence however meanwhile moreover nevertheless therefore please let many most some several few each every all both no not one two three".split()
)

_MARKER = re.compile(r"(?:(?<=\s)|^)(?P<bullet>[•⁃*‣-]\s?)?(?P<count>\d{1,3}|[a-z])(?P<style>\.\)|\)|\.)(?=\s)")
_ENDS = re.compile(r"(?:(?<=\s)|(?<=\w))\.(?:\s\.){2,}|[.!?…]+")
_CLOSERS = "\"'’”)]»"
_OPENERS = "\"'‘“([«"
_PAIRS = {"(": ")", "[": "]", "“": "”", "«": "»"}
_ENCLOSING = re.compile("[()\\[\\]“”«»\"']")
_BLANKS = re.compile(r"\s*")
#: Characters before and behind an end mark that are looked at.
NEAR = 60
_WORD = re.compile(r"[\w.&'’°§-]+$")
_NEXT = re.compile(r"[^\W_][\w'’]*")


def _items(line: str) -> list[tuple[int, int]]:
    """Where list items start, and where their markers end."""
    found: list[tuple[int, int]] = []
    style, count = None, 0
    for m in _MARKER.finditer(line):
        own = m["count"]
        number = int(own) if own.isdigit() else ord(own) - 96
        kind = bool(m["bullet"]), m["style"], own.isdigit()
        if not found:
            if line[: m.start()].strip():
                break
        elif kind != style or number != count + 1:
            continue
        style, count = kind, number
        found.append((m.start(), m.end()))
    return found if len(found) > 1 else []


def _enclosed(line: str) -> tuple[list[int], set[int]]:
    """At each place, in how many brackets and quotations it lies; and where these end."""
    step, ends = [0] * (len(line) + 2), set()
    waiting: list[tuple[str, int]] = []
    held: Counter[str] = Counter()

    def close(at: int) -> None:
        kind, first = waiting.pop()
        held[kind] -= 1
        step[first + 1] += 1
        step[at + 1] -= 1
        ends.add(at)

    for m in _ENCLOSING.finditer(line):
        i, c = m.start(), m[0]
        if waiting and c == waiting[-1][0] and not (c == "'" and line[i + 1 : i + 2].isalnum()):
            close(i)
        elif c in _PAIRS or c == '"' or c == "'" and (i == 0 or line[i - 1] in ' \t(["“'):
            waiting.append((_PAIRS.get(c, c), i))
            held[_PAIRS.get(c, c)] += 1
        elif c in ")]”»" and held[c]:
            while waiting[-1][0] != c:
                held[waiting.pop()[0]] -= 1
            close(i)
    return list(accumulate(step)), ends


def _glued(line: str, at: int) -> bool:
    """Whether a full stop without a blank behind it ends a sentence: a word or number and a capitalised word."""
    token_start = max(line.rfind(" ", 0, at), line.rfind("\t", 0, at)) + 1
    token = line[max(token_start, at - 200) : at + 200].split(None, 1)[0]
    before = re.search(r"[\w,]+$", line[max(token_start, at - NEAR) : at])
    behind = re.match(r"[A-Z][a-z]+(?=[\s.,!?]|$)", line[at + 1 : at + 1 + NEAR])
    return bool(before and behind and len(before[0]) > 2 and not re.search(r"[@/:_\\]", token))


def _stop(line: str, start: int, at: int, behind: str) -> bool:
    """Whether a full stop at a place, with a blank and then ``behind`` after it, ends the sentence from ``start``."""
    before = _WORD.search(line, max(start, at - NEAR), at)
    word = before[0].strip("'’-") if before else ""
    low = word.lower()
    following = _NEXT.match(behind.lstrip(_OPENERS))
    starts = bool(following) and following[0].lower().split("'")[0].split("’")[0] in STARTERS and following[0][0].isupper()
    if low in ("a.m", "p.m"):  # a time in front of its sentence is not the end of one
        return len(line[start : before.start()].split(None, 3)) > 2
    if low in TITLES or low in JOINING:
        return False
    if low in NUMBERED:
        return not re.match(r"[\d(#IVXLC]", behind)
    if low in OTHERS or re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", word) or len(word) == 1 and word.isalpha() and word.isupper():
        return starts
    return True


def sentences(line: str) -> list[str]:
    """The sentences of a line, without blanks around them."""
    items = _items(line)
    markers = {end - 1 for _, end in items}
    firsts = [start for start, _ in items]
    cuts = firsts[1:]
    depth, closed = _enclosed(line)
    start = 0
    for m in _ENDS.finditer(line):
        at, end = m.start(), m.end()
        if firsts:
            start = max(start, firsts[max(0, bisect_right(firsts, at) - 1)])
        if at in markers or end in markers or end - 1 in markers:
            continue
        stop = end
        while stop < len(line) and line[stop] in _CLOSERS and (line[stop] not in "\"'" or stop in closed):
            stop += 1
        onward = _BLANKS.match(line, stop).end()
        behind = line[onward : onward + NEAR]
        if not behind or depth[stop]:
            continue
        marks = m[0]
        if stop == len(line) or not line[stop].isspace():
            if marks == "." and stop == end and _glued(line, at):
                cuts.append(start := end)
            continue
        first = behind.lstrip(_OPENERS)[:1]
        if first.islower() or line[max(0, at - 1) : end + 1] == "[...]":
            continue
        if " " in marks:  # spaced dots: three stand for what was left out, a fourth one ends the sentence
            dots = marks.count(".")
            if line[at - 1 : at].isspace():
                ends = dots > 3
            else:
                ends, stop = dots > 3, at + 1
            if ends:
                cuts.append(start := stop)
        elif marks != "." or _stop(line, start, at, behind):
            cuts.append(start := stop)
    bounds = [0, *sorted(set(cuts)), len(line)]
    parts = (line[a:b].strip() for a, b in zip(bounds, bounds[1:]))
    return [x for x in parts if x]
