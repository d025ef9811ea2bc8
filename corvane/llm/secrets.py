"""Secret scans: fixed patterns, and a linear-chain conditional random field over words.

The field tags every word of a text as the begin of a secret, inside one or outside, from the
word's shape, the words around it and features of the whole text, and is decoded by Viterbi.  It is
trained here on ``TRAINING`` made-up lines (a fixed bound; no table is read for it).  Viterbi
runs over the words that could be anything but outside: where no secret that holds the word could
gain anything over outside, whatever the transitions, the best path passes through outside, so
the text is cut there without changing the result.

Spans are kind:start:end in code points, end exclusive, sorted by start and then by kind.  The
spans of the patterns always stay; one of the field is added unless it lies wholly inside one of
them, so spans may overlap, and ``redact`` masks what any of them covers.
Null and empty texts have no spans.  A text of any length is tagged whole, in memory of some 200 bytes a word.  Rows are independent: repeated rows give repeated results, an
empty table an empty one.  Only doc_id and text are read; ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _text as t
from ._session import table

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: What every assignment contains, in lower case.
_STEMS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_HEXADECIMAL = np.zeros(256, bool)
_HEXADECIMAL[list(b"0123456789abcdef")] = True
#: Words that announce a secret, and marks that stand between them and it.
KEYWORDS = ("password", "passwd", "pwd", "passphrase", "secret", "client_secret", "token", "access_token", "refresh_token", "api_key", "apikey", "api-key", "key", "access_key", "secret_key", "private_key", "auth", "authorization", "bearer", "credential", "credentials", "passwort", "contraseña")
SEPARATORS = ("=", ":", ":=", "=>", "->")
#: Lines of the training set, steps and weight decay of its fit, and its seed.
TRAINING, EPOCHS, DECAY, SEED = 2000, 100, 1e-3, 11
OUT, BEGIN, INSIDE = range(3)
FEATURES = (
    "always", "digit", "digit and letter", "three kinds", "8 long", "16 long", "24 long", "32 long", "4 turns", "8 turns", "mostly marks",
    "digits only", "beyond ASCII", "capitals and digits, 12 long", "rule of hyphens", "at sign", "slash", "after a keyword", "two after a keyword",
    "after a separator", "before a separator", "keyword", "after an open mark", "after a dense word", "before a dense word", "after a rule of hyphens",
    "text has a keyword", "text is full of marks", "text is full of codes", "dense, 20 long", "plain letters",
    "hyphen inside", "dot inside", "underscore", "colon inside", "bracket or semicolon inside", "equals sign inside", "many turns", "a third digits", "half vowels or more", "hexadecimal", "letters in front", "three hyphens",
)
_KIND = np.full(256, 3, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 mark, 4 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4
_TRIM = np.zeros(256, bool)
_TRIM[list(b"\"'`,;:.()[]{}<>|")] = True
_VOWEL = np.zeros(256, bool)
_VOWEL[list(b"aeiouAEIOU")] = True
_CORE = re.compile(r"[A-Za-z0-9+/_.~$!@#%^&*=-]{4,}")


def _one_block(texts: list[str]) -> t.Block:
    return next(t.blocks(pa.array(texts), 1 << 40))


@cache
def _known(words: tuple[str, ...]) -> np.ndarray:
    block = _one_block(list(words))
    return np.sort(t.span_hash(block.data, block.at[:-1], block.at[1:], lower=True))


def features(block: t.Block) -> tuple[t.Words, np.ndarray]:
    """The words of a block and a row of FEATURES for each, as 0 or 1."""
    words = t.words(block)
    start, end = words.start, words.end
    kind = _KIND[block.data]
    count = []
    for k in range(5):
        upto = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind == k, out=upto[1:])
        count.append(upto[end] - upto[start])
    lower, upper, digit, mark, high = count
    turns = np.zeros(len(kind) + 1, np.int32)
    np.cumsum(kind[1:] != kind[:-1], out=turns[1 : len(kind)])
    turns = turns[end - 1] - turns[start] if len(start) else np.zeros(0, np.int32)
    long = end - start
    a, b = start.copy(), end.copy()
    for _ in range(2):
        move = (a < b - 1) & _TRIM[block.data[a]]
        a = a + move
        move = (a < b - 1) & _TRIM[block.data[b - 1]]
        b = b - move
    keyword = np.isin(t.span_hash(block.data, a, b, lower=True), _known(KEYWORDS))
    separator = np.isin(t.span_hash(block.data, start, end, lower=True), _known(SEPARATORS))
    first = block.data[start] if len(start) else np.zeros(0, np.uint8)
    final = block.data[end - 1] if len(start) else np.zeros(0, np.uint8)
    letters = lower + upper
    has = lambda byte: (lambda u: u[end] > u[start])(np.concatenate([[0], np.cumsum(block.data == byte)]))
    upto = lambda marks: (lambda u: u[end] - u[start])(np.concatenate([[0], np.cumsum(marks)]))
    inside = lambda byte: (lambda u: u[np.maximum(b - 1, a)] > u[np.minimum(a + 1, b)])(np.concatenate([[0], np.cumsum(block.data == byte)]))
    vowel, hexadecimal, hyphens = upto(_VOWEL[block.data]), upto(_HEXADECIMAL[block.data]), upto(block.data == 45)
    fronted = np.ones(len(start), bool)  # four letters of one kind after the first one
    for k in range(1, 4):
        at = np.minimum(start + k, len(kind) - 1)
        fronted &= (start + k < end) & (kind[at] == 0)
    rule = (first == 45) & (long >= 6) & (mark >= 5)
    rule |= (final == 45) & (long >= 6) & (mark >= 5)
    dense = (digit > 0) & (letters > 0) & (long >= 8) & (turns >= 3) & (high == 0)
    opened = (final == 61) | (final == 58)

    def before(x: np.ndarray, by: int = 1) -> np.ndarray:
        out = np.zeros(len(x), bool)
        out[by:] = x[:-by] & (words.doc[by:] == words.doc[:-by])
        return out

    def after(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        out[:-1] = x[1:] & (words.doc[1:] == words.doc[:-1])
        return out

    n = np.maximum(np.diff(words.at), 1)
    keyed = (t.per_row(keyword, words.at) > 0)[words.doc]
    marked = (t.per_row(mark, words.at) > 2 * n)[words.doc]
    coded = (t.per_row(dense, words.at) > 0.1 * n)[words.doc]
    rows = [
        np.ones(len(start), bool), digit > 0, (digit > 0) & (letters > 0), (digit > 0) & (lower > 0) & (upper > 0), long >= 8, long >= 16, long >= 24, long >= 32, turns >= 4, turns >= 8, 3 * mark > long,
        digit == long, high > 0, (upper + digit == long) & (upper > 0) & (digit > 0) & (long >= 12), rule, has(64), has(47), before(keyword), before(keyword, 2),
        before(separator), after(separator), keyword, before(opened), before(dense), after(dense), before(rule),
        keyed, marked, coded, dense & (long >= 20), letters + high == long,
        inside(45), inside(46), has(95), inside(58), inside(40) | inside(91) | inside(59), inside(61), 3 * turns > long, 3 * digit > long, 2 * vowel >= letters, hexadecimal == long, fronted, hyphens >= 3,
    ]
    return words, np.array(rows)


def _made_up(rng: np.random.Generator) -> list[tuple[str, list[int]]]:
    """Training lines with a tag for each word."""
    syllables = "the re in on er an ti es en at ed nd or ing le de que ou ai é è ment tion ver ein ge un ü ß ch os ar ción ñ".split()
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, n: "".join(pick(alphabet) for _ in range(n))
    low, cap, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    wide = low + cap + num

    def word() -> str:
        w = "".join(pick(syllables) for _ in range(int(rng.integers(1, 5))))
        w = w.capitalize() if rng.random() < 0.15 else w.upper() if rng.random() < 0.02 else w
        return w + (pick([".", ",", ";", ":", "!"]) if rng.random() < 0.15 else "")

    plain = lambda n=3: "".join(pick(syllables) for _ in range(int(rng.integers(1, n + 1))))
    hexa = "0123456789abcdef"
    date = lambda: f"{rng.integers(1990, 2031)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    clock = lambda: f"{rng.integers(0, 24):02d}:{rng.integers(0, 60):02d}:{rng.integers(0, 60):02d}"
    coded = lambda n: chars(wide + "+/", n)
    # what is dense without being secret: identifiers, times, addresses, names of things
    named = [
        lambda: "-".join(chars(hexa, n) for n in (8, 4, 4, 4, 12)), lambda: "urn:uuid:" + "-".join(chars(hexa, n) for n in (8, 4, 4, 4, 12)), lambda: "-".join(chars(hexa.upper(), n) for n in (8, 4, 4, 4, 12)),
        lambda: f"{date()}T{clock()}" + pick(["Z", ".123Z", "+02:00", ""]), lambda: f"{date()}_{clock().replace(':', '')}", lambda: f"data:image/{pick(['png', 'gif', 'jpeg'])};base64,{coded(int(rng.integers(40, 200)))}", lambda: f'src="data:font/woff;base64,{coded(60)}"',
        lambda: plain(2) + "".join(plain(2).capitalize() for _ in range(int(rng.integers(1, 4)))) + pick(["", "2", "3D", "V2", str(rng.integers(1, 99))]) + pick(["", "", "()", "(x)", ";"]), lambda: "_".join(plain(2) for _ in range(int(rng.integers(2, 5)))) + pick(["", f"_{rng.integers(1, 99)}", "_v2", "[0]"]), lambda: "_".join(plain(2).upper() for _ in range(2)) + f"_{rng.integers(1, 999)}",
        lambda: f"{plain(1).upper()}{rng.integers(1, 99)}:c.{rng.integers(1, 9999)}{pick('ACGT')}>{pick('ACGT')}", lambda: f"rs{chars(num, 8)}", lambda: f"p.{pick(['Val', 'Glu', 'Arg'])}{rng.integers(10, 999)}{pick(['Lys', 'Ter', 'fs'])}", lambda: f"NM_{chars(num, 6)}.{rng.integers(1, 9)}", lambda: f"{plain(1).upper()}-{rng.integers(2, 9)}{pick('ABCDE')}{rng.integers(1, 99)}",
        lambda: f"https://{plain()}.{pick(['com', 'io', 'net'])}/{plain()}?id={rng.integers(1, 99999)}&{plain(2)}={plain(2)}{rng.integers(1, 99)}", lambda: f"/{plain()}/{plain()}/{plain(2)}{rng.integers(1, 99)}.{pick(['py', 'tar.gz', 'so.1', 'json'])}", lambda: f"{plain()}-{rng.integers(0, 9)}.{rng.integers(0, 30)}.{rng.integers(0, 9)}-{pick(['cp313', 'x86_64', 'beta2', 'rc1'])}", lambda: ":".join(chars(hexa, 2) for _ in range(6)), lambda: "#" + chars(hexa, 6), lambda: "0x" + chars(hexa, int(rng.integers(2, 17))),
        lambda: f"978-{rng.integers(0, 9)}-{chars(num, 4)}-{chars(num, 4)}-{rng.integers(0, 9)}", lambda: f"10.{rng.integers(1000, 9999)}/{plain(2)}.{rng.integers(1990, 2030)}.{chars(num, 5)}", lambda: f"{pick(['DE', 'FR', 'GB'])}{chars(num, 18)}", lambda: f"{pick(cap)}{pick(cap)}{chars(num, 2)}-{chars(cap + num, 4)}", lambda: f"sha256:{chars(hexa, 12)}", lambda: chars(hexa, 7), lambda: f"{plain(2)}{rng.integers(1, 99)}x{rng.integers(1, 99)}{plain(1)}", lambda: f"{rng.integers(1, 9)}{pick(['H2O', 'C6H12O6', 'NaHCO3', 'Fe2O3'])}",
    ]

    def other() -> str:
        return pick([
            lambda: chars(num, int(rng.integers(1, 17))), lambda: f"{rng.integers(1, 29)}.{rng.integers(1, 13)}.{rng.integers(1900, 2030)}", lambda: f"{word().strip('.,;:!')}@{word().strip('.,;:!')}.com", lambda: f"{chars(low, int(rng.integers(3, 9)))}.{rng.integers(10, 99)}@mail{rng.integers(1, 9)}.example.com",
            lambda: f"https://{word().strip('.,;:!')}.org/{word().strip('.,;:!')}/{rng.integers(1, 999)}", lambda: f"+{rng.integers(1, 99)}-{rng.integers(100, 999)}-{rng.integers(1000, 9999)}", lambda: f"{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}",
            lambda: f"v{rng.integers(1, 9)}.{rng.integers(0, 20)}", lambda: "|", lambda: word() + pick(["***", "$$$", "%%%", "&&&", "###"]), lambda: pick(cap) + chars(num, 2), lambda: f"/{word().strip('.,;:!')}/{word().strip('.,;:!')}.txt", lambda: f"${rng.integers(1, 999)}.{rng.integers(10, 99)}",
            *named,
            lambda: word().strip(".,;:!") + "-" + word(), lambda: f"{rng.integers(1, 12)}:{rng.integers(10, 59)}", lambda: "----------", lambda: "=", lambda: "<b>" + word() + "</b>", lambda: word().strip(".,;:!") + str(rng.integers(1, 99)),
        ])()

    def value() -> str:
        return pick([
            lambda: chars("0123456789abcdef", int(pick([16, 20, 32, 40, 64]))), lambda: chars(wide, int(rng.integers(12, 44))), lambda: chars(wide + "+/", int(rng.integers(24, 60))) + pick(["", "=", "=="]), lambda: chars(wide + "!@#$%^&*", int(rng.integers(9, 20))) + pick(num),
            lambda: pick(["ghp_", "sk_live_", "xoxb-", "glpat-", "AIza"]) + chars(wide, int(rng.integers(20, 40))), lambda: "eyJ" + chars(wide, 20) + "." + chars(wide, 30) + "." + chars(wide + "_-", 25),
        ])()

    def line() -> tuple[str, list[int]]:
        words, tags = [], []

        def put(ws: list[str], tag: int = OUT) -> None:
            for i, w in enumerate(ws):
                words.append(w)
                tags.append(tag if tag == OUT or not i else INSIDE)

        noisy = rng.random() < 0.08  # every word with the same kind of marks
        technical = rng.random() < 0.15  # full of identifiers, times and addresses

        def prose(n: int) -> None:
            put([word() + pick(["***", "$$$", "%%%", "&&&", "###"]) for _ in range(n)] if noisy else [other() if rng.random() < (0.6 if technical else 0.12) else word() for _ in range(n)])

        prose(int(rng.integers(0, 14)))
        kind = rng.random()
        quote = pick(["", "", '"', "'"])
        key = pick(KEYWORDS)
        key = key.capitalize() if rng.random() < 0.2 else key.upper() if rng.random() < 0.2 else key
        owner = pick(["", "", "", plain(1) + pick(["_", "-", ""]), pick(["db", "user", "aws", "my"]) + pick(["_", ""])])
        key = owner + (key.capitalize() if owner and owner[-1] not in "_-" else key)
        if kind < 0.25:
            put([key, pick(["=", ":", ":=", "is"])])
            put([quote + value() + quote + pick(["", ",", ";"])], BEGIN)
        elif kind < 0.35:
            put([key + pick([":", "="])])
            put([quote + value() + quote], BEGIN)
        elif kind < 0.42:
            put([f"{key}{pick('=:')}{quote}{value()}{quote}"], BEGIN)
        elif kind < 0.50:
            put([pick(["ghp_", "sk_live_", "xoxb-", "glpat-", "AKIA"]) + chars(cap + num if rng.random() < 0.3 else wide, int(rng.integers(16, 40)))], BEGIN)
        elif kind < 0.55:
            put(["-----BEGIN", pick(["RSA", "EC", "OPENSSH"]), "PRIVATE", "KEY-----", *[chars(wide + "+/", 64) for _ in range(int(rng.integers(1, 5)))], "-----END", "RSA", "PRIVATE", "KEY-----"], BEGIN)
        elif kind < 0.75:  # a keyword in prose
            put([key, *([pick(["=", ":", "is"])] if rng.random() < 0.5 else []), other() if rng.random() < 0.5 else word()])
        prose(int(rng.integers(0, 14)))
        return " ".join(words), tags

    return [line() for _ in range(TRAINING)]


@cache
def model() -> tuple[np.ndarray, np.ndarray]:
    """Weights of each feature and tag, and of each pair of tags (row 3: before the first word).

    Maximum likelihood by Adam on the made-up lines, all of them at once; gradients come from
    the forward-backward recursion.
    """
    lines = _made_up(np.random.default_rng(SEED))
    words, f = features(_one_block([x for x, _ in lines]))
    n, most = len(lines), int(np.diff(words.at).max())
    place = np.arange(len(words.doc)) - words.at[words.doc]
    x = np.zeros((most, n, len(FEATURES)), np.float32)
    x[place, words.doc] = f.T
    live = np.zeros((most, n), bool)
    live[place, words.doc] = True
    gold = np.zeros((most, n), np.int64)
    gold[place, words.doc] = np.concatenate([g for _, g in lines])
    w, tr = np.zeros((len(FEATURES), 3)), np.zeros((4, 3))
    bad = np.zeros((4, 3))
    bad[[OUT, 3], INSIDE] = -1e3  # nothing starts inside
    hot = np.eye(3)[gold] * live[..., None]
    want_w = np.einsum("lnf,lnk->fk", x, hot)
    pair_live = live[1:][..., None]
    want_t = np.vstack([np.einsum("lni,lnj->ij", hot[:-1], hot[1:] * pair_live), hot[0].sum(0)])
    grads = [np.zeros_like(w), np.zeros_like(tr)]
    squares = [np.zeros_like(w), np.zeros_like(tr)]
    log_sum = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
    for step in range(1, EPOCHS + 1):
        full = tr + bad
        e = x @ w.astype(np.float32)
        alpha = np.empty((most, n, 3))
        alpha[0] = e[0] + full[3]
        for i in range(1, most):
            alpha[i] = np.where(live[i][:, None], log_sum(alpha[i - 1][:, :, None] + full[:3], 1) + e[i], alpha[i - 1])
        beta = np.zeros((most, n, 3))
        for i in range(most - 2, -1, -1):
            beta[i] = np.where(live[i + 1][:, None], log_sum(full[:3] + (e[i + 1] + beta[i + 1])[:, None, :], 2), beta[i + 1])
        z = log_sum(alpha[-1], 1)
        node = np.exp(alpha + beta - z[:, None]) * live[..., None]
        pair = np.exp(alpha[:-1, :, :, None] + full[:3] + (e[1:] + beta[1:])[:, :, None, :] - z[:, None, None]) * pair_live[..., None]
        g = [(want_w - np.einsum("lnf,lnk->fk", x, node)) / n - DECAY * w, (want_t - np.vstack([pair.sum((0, 1)), node[0].sum(0)])) / n - DECAY * tr]
        for k, value in enumerate((w, tr)):
            grads[k] = 0.9 * grads[k] + 0.1 * g[k]
            squares[k] = 0.99 * squares[k] + 0.01 * g[k] ** 2
            value += 0.1 * (grads[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-8)
    return w.round(6), (tr + bad).round(6)


def viterbi(e: np.ndarray, tr: np.ndarray, first: bool, last: bool) -> list[int]:
    """Best tags of some words with scores e; before and after them are the text's ends or outside."""
    best, back = e[0] + tr[3 if first else OUT], []
    for i in range(1, len(e)):
        step = best[:, None] + tr[:3]
        back.append(step.argmax(0))
        best = step.max(0) + e[i]
    tags = [int((best if last else best + tr[:3, OUT]).argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def tag(block: t.Block, w: np.ndarray, tr: np.ndarray) -> tuple[t.Words, np.ndarray]:
    """The words of a block and the tag of each on its text's best path."""
    words, f = features(block)
    tags = np.zeros(len(words.start), np.int8)
    if not len(tags):
        return words, tags
    e = (f.T.astype(np.float64) @ w).T
    # what a secret that begins here, or goes on, gains at most over outside; runs end with their text
    usual = min(tr[OUT, OUT], tr[3, OUT])
    begin = e[BEGIN] - e[OUT] + tr[:, BEGIN].max() - usual
    inside = e[INSIDE] - e[OUT] + tr[:3, INSIDE].max() - tr[OUT, OUT]
    inside[words.at[:-1][np.diff(words.at) > 0]] = -1e6
    upto = np.cumsum(inside)
    so_far = upto + np.maximum.accumulate(begin - upto)
    further = np.maximum.accumulate(upto[::-1])[::-1] - upto
    exits = max(0.0, tr[:3, OUT].max() - tr[OUT, OUT]) + tr[:, BEGIN].max() - tr[OUT, BEGIN]
    open_ = np.flatnonzero(so_far + further + exits > -1e-6)
    if len(open_):
        cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(words.doc[open_]) > 0)) + 1
        e = e.T
        for run in np.split(open_, cut):
            a, b = int(run[0]), int(run[-1]) + 1
            doc = words.doc[a]
            tags[a:b] = viterbi(e[a:b], tr, a == words.at[doc], b == words.at[doc + 1])
    return words, tags


def base_spans(text: str, raw: bytes, hexadecimal: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find; raw is the text in UTF-8."""
    out = []
    low = raw.lower()
    if any(x in low for x in _STEMS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hexadecimal:
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _long_hex(block: t.Block) -> np.ndarray:
    """Which documents may have 24 hexadecimal digits in a row."""
    upto = np.zeros(len(block.data) + 1, np.int32)
    np.cumsum(_HEXADECIMAL[block.data], out=upto[1:])
    at = np.flatnonzero(upto[24:] - upto[:-24] == 24) if len(block.data) >= 24 else np.zeros(0, np.int64)
    out = np.zeros(block.rows, bool)
    out[np.searchsorted(block.at, at, "right") - 1] = True
    return out


def all_spans(block: t.Block, w: np.ndarray, tr: np.ndarray) -> Iterator[tuple[str, list, list]]:
    """Text, pattern spans and all spans of each document of a block."""
    words, tags = tag(block, w, tr)
    begins = np.flatnonzero(tags == BEGIN)
    ends = _ends(tags, begins)
    found = np.searchsorted(words.doc[begins], np.arange(block.rows + 1))
    hexadecimal = _long_hex(block)
    for i in range(block.rows):
        raw = block.data[block.at[i] : block.at[i + 1]].tobytes()
        text = raw.decode()
        base = base_spans(text, raw, bool(hexadecimal[i]))
        spans = list(base)
        for k in range(found[i], found[i + 1]):
            a, b = words.start[begins[k]] - block.at[i], words.end[ends[k] - 1] - block.at[i]
            at, piece = len(raw[:a].decode()), raw[a:b].decode()
            if ends[k] - begins[k] == 1 and (cores := [m.span() for m in _CORE.finditer(piece)]):
                low, high = max(cores, key=lambda m: m[1] - m[0])
                low = max(low, piece.rfind("=", low, high - 4) + 1) if piece.rstrip("\"'=,;").rfind("=", low, high) > 0 else low
                a, b = at + low, at + high
            else:
                a, b = at, at + len(piece)
            if not any(x <= a and b <= y for x, _, y in base):
                spans.append((a, 3, b))
        yield text, base, sorted(spans)


def _ends(tags: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One past the last word of the secret that begins at each of ``begins``."""
    stops = np.append(np.flatnonzero(tags != INSIDE), len(tags))
    return stops[np.searchsorted(stops, begins, "right")]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"


def scan(docs: DataFrame) -> DataFrame:
    """Counts and spans of the secrets in each text of ``docs`` (doc_id, text)."""
    w, tr = model()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                out = []
                for _, base, spans in all_spans(block, w, tr):
                    kinds = [k for _, k, _ in spans]
                    out.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), kinds.count(3)))
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, block.rows), *columns], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(t.released(rows), SCHEMA)


MASK = "<secret>"


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret's span replaced by a mask; n_chars, if there, follows the text."""
    w, tr = model()
    schema = docs.schema

    def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [text[at:a], MASK]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, where = batch.schema.names, batch.schema.names.index("text")
            for block in t.blocks(batch.column("text")):
                part = batch.slice(block.first, block.rows)
                old = part.column("text")
                done = [(masked(text, spans), bool(spans)) for text, _, spans in all_spans(block, w, tr)]
                new = [x if hit else o.as_py() for (x, hit), o in zip(done, old, strict=True)]
                columns = list(part.columns)
                columns[where] = pa.array(new, old.type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    columns[k] = pa.array([len(x) if hit else n.as_py() for (x, hit), n in zip(done, columns[k], strict=True)], columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(t.released(rows), schema)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
