"""Personal data: exact base rules, and a skip-chain conditional random field over the tokens of each text that labels alike tokens alike."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from one @ to the next: a match starts where the run of local characters before it starts, or where the last match
    ended. A run is read backwards once, so long runs cost no more than their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1, start):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
            at = text.find("@", end)
        else:
            end = at + 1
            at = text.find("@", end)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """A match begins at the start of a run of digits: from later in the run the same would match or fail."""
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def base_spans(text: str) -> list[Span]:
    """The spans of the base rules, by kind and start; offsets count code points."""
    return [(kind, a, b) for kind in KINDS for a, b in _FINDERS[kind](text)]


# The field. Its variables are the tokens of a text. A token that holds no digit and no address can only be none; such labels are fixed
# and split the chain, so the nodes are the tokens that could be personal, and the words beside them are part of what is observed.

#: Tokens that could be personal: digits with separators, dotted numbers, addresses in plain or veiled form.
_DIGITS = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20()./-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
_DOTTED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20?(?:[(\[{](?:\.|dot)[)\]}]|\.)\x20?[0-9]{1,3}){3}(?![0-9])")
_AT = re.compile(r"\x20?(?:@|[(\[{](?:at|AT|@)[)\]}])\x20?|\x20(?:at|AT)\x20")
_DOT = re.compile(r"\x20?(?:\.|[(\[{](?:dot|DOT|\.)[)\]}])\x20?|\x20(?:dot|DOT)\x20")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\x20?(?:\.|[(\[{](?:dot|DOT|\.)[)\]}])\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]++)+")
_WORD = re.compile(r"[A-Za-z]+(?:-[A-Za-z]+)?")
_ALNUM = re.compile(r"[^\W_]")
_FORMS = ("digits", "dotted", "address")
_FORM_OF = {"email": "address", "ip": "dotted", "card": "digits", "phone": "digits"}
_LABELS = ("none", *KINDS)
_K = len(_LABELS)
#: Labels that a form can have.
_CAN = np.array([[True, *(_FORM_OF[k] == f for k in KINDS)] for f in _FORMS])
#: Words that speak for a kind, and words that speak for none.
CUES = {
    "email": "mail email e-mail mailto write inbox",
    "ip": "ip ipv4 host server gateway dns ping router subnet",
    "card": "card visa mastercard amex credit debit cvv",
    "phone": "phone tel telephone call mobile cell fax dial whatsapp sms",
    "none": "order invoice version section isbn page ref serial account tracking total release chapter build figure id",
}
_CUE = {w: k for k, ws in enumerate(CUES.values()) for w in ws.split()}
#: Words before and behind a token that are looked at, and how far they may be.
_BEFORE, _BEHIND, _FAR = 3, 1, 48
_DAMP = 0.5
#: Messages pass until none changes by this much; the bound on rounds only ends a field that swings.
_CHANGE, _ROUNDS = 1e-4, 2000
#: A token becomes a span from this belief on.
BELIEF = 0.8
#: Kinds of edges: neighbours in the text, equal keys, keys with equal ends, and keys that differ by one character, by form.
EDGES = ("next", "equal", "ending", *(f"alike_{f}" for f in _FORMS))
_NEXT, _EQUAL, _ENDING, _ALIKE = 0, 1, 2, 3
_ENDING_DIGITS = 9
_ALIKE_LEAST = 9


def _key(form: str, piece: str) -> str:
    """What mentions of one thing have in common."""
    if form == "digits":
        return "d" + _NOT_DIGIT.sub("", piece).lstrip("0")
    return form[1] + _AT.sub("@", _DOT.sub(".", piece.lower()), count=1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Local parts and hosts around each mark that stands for an at sign; each character is read a bounded number of times."""
    end = 0
    for m in _AT.finditer(text):
        if m.start() < end or not (host := _HOST.match(text, m.end())):
            continue
        start = m.start()
        while start > end and _LOCAL.match(text, start - 1, start):
            start -= 1
        if start < m.start():
            end = host.end()
            yield start, end


def tokens(text: str, base: list[Span]) -> list[tuple[int, int, int, int]]:
    """``start, end, form, label`` of the tokens that could be personal, in order; the label is that of a base span, else 0. Looser tokens
    that overlap a base span or a token of an earlier form are left out."""
    out = [(a, b, _FORMS.index(_FORM_OF[k]), 1 + KINDS.index(k)) for k, a, b in base]
    finders = (lambda: _addresses(text), lambda: (m.span() for m in _DOTTED.finditer(text)), lambda: (m.span() for m in _DIGITS.finditer(text)))
    for form, find in zip((2, 1, 0), finders, strict=True):
        taken = sorted((a, b) for a, b, _, _ in out)
        starts, ends, reach = [a for a, _ in taken], [], 0
        for _, b in taken:
            reach = max(reach, b)
            ends.append(reach)
        for a, b in find():
            before = bisect_left(starts, b) - 1  # the last one that starts before the end
            if before < 0 or ends[before] <= a:
                out.append((a, b, form, 0))
    return sorted(out)


def _words_beside(text: str, a: int, b: int) -> list[int]:
    """How many of the words beside a token speak for each kind, and for none."""
    before = [m.group().lower() for m in _WORD.finditer(text, max(0, a - _FAR), a)][-_BEFORE:]
    behind = [m.group().lower() for m in _WORD.finditer(text, b, b + _FAR)][:_BEHIND]
    said = [0] * len(CUES)
    for w in before + behind:
        if w in _CUE:
            said[_CUE[w]] = 1
    return said


def _features(text: str, a: int, b: int, form: int) -> list[float]:
    """What is observed of a token: its form, its digits, its marks, and the words beside it."""
    piece = text[a:b]
    digits = _NOT_DIGIT.sub("", piece)
    n = len(digits)
    card = form == 0 and 13 <= n <= 19 and luhn(digits)
    parts = [int(p) for p in re.findall("[0-9]+", piece)] if form == 1 else []
    veiled = form == 2 and "@" not in piece and bool(re.search(r"[(\[{]", piece))
    host = _DOT.split(piece)[-1] if form == 2 else ""
    plus = a > 0 and text[a - 1] == "+" or piece.startswith("+")
    grouped = form == 0 and n != b - a
    own = [form == 0, form == 1, form == 2, card, form == 0 and 13 <= n <= 19 and not card, form == 0 and 9 <= n <= 12, form == 0 and n < 9, form == 0 and n > 19, grouped, grouped and 9 <= n <= 12, form == 0 and plus, form == 1 and max(parts) <= 255, form == 1 and max(parts) > 255, veiled, form == 2 and "@" in piece, form == 2 and host.isalpha() and len(host) >= 2]
    return [1.0, *map(float, own), *map(float, _words_beside(text, a, b))]


def _alike(keys: dict[str, int]) -> list[tuple[int, int]]:
    """Pairs of keys, given with their first tokens, that are equal once each has lost one character at most. Each key is linked to the
    last one before with a common form of one character less; forms are compared by hashes of what lies before and behind the
    gap and then by themselves, so a key costs its length."""
    prime, base = (1 << 61) - 1, 1_000_003
    near: dict[int, tuple[int, str, int]] = {}
    out = []
    for key, k in keys.items():
        n = len(key)
        if n <= _ALIKE_LEAST:
            continue
        head, power = [0], [1]
        for c in key:
            head.append((head[-1] * base + ord(c)) % prime)
            power.append(power[-1] * base % prime)
        for gap in range(1, n + 1):  # a gap behind the end leaves the whole key
            h = (head[gap] * power[n - gap - 1] + head[n] - head[gap + 1] * power[n - gap - 1]) % prime if gap < n else head[n]
            other = near.get(h)
            if other and other[0] != k and key[:gap] + key[gap + 1 :] == other[1][: other[2]] + other[1][other[2] + 1 :]:
                out.append((other[0], k))
            near[h] = (k, key, gap)
    return out


def edges(text: str, nodes: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """``i, j, kind`` of the field's edges, as many as a multiple of the nodes and the lengths of their keys.

    Neighbours with no word between them are linked. Tokens with one key are linked to the next one with it, and to the first
    base span with it. So are keys of numbers with equal last digits and keys that differ by one character: all tokens of the one to the
    first base span of the other, or else their first tokens.
    """
    keys = [_key(_FORMS[f], text[a:b]) for a, b, f, _ in nodes]
    out = {(i, i + 1, _NEXT) for i in range(len(nodes) - 1) if nodes[i][1] <= nodes[i + 1][0] and not _ALNUM.search(text, nodes[i][1], nodes[i + 1][0])}
    of: dict[str, list[int]] = {}
    star: dict[str, int] = {}
    for k, key in enumerate(keys):
        of.setdefault(key, []).append(k)
        if nodes[k][3]:
            star.setdefault(key, k)
    for key, some in of.items():
        out |= {(i, j, _EQUAL) for i, j in zip(some, some[1:], strict=False)}
        if key in star:
            out |= {(min(star[key], k), max(star[key], k), _EQUAL) for k in some if k != star[key]}

    def link(one: str, two: str, kind: int) -> None:
        for a, b in ((one, two), (two, one)):
            if a in star:
                out.update((min(star[a], k), max(star[a], k), kind) for k in of[b])
        if one not in star and two not in star:
            out.add((min(of[one][0], of[two][0]), max(of[one][0], of[two][0]), kind))

    ending: dict[str, str] = {}
    for key in of:
        if key[0] == "d" and len(key) > _ENDING_DIGITS:
            end = key[-_ENDING_DIGITS:]
            if end in ending:
                link(ending[end], key, _ENDING)
            if key in star or end not in ending:
                ending[end] = key
    for one, two in _alike({key: some[0] for key, some in of.items()}):
        link(keys[one], keys[two], _ALIKE + nodes[two][2])
    return sorted(out)


class Field:
    """Weights of what is observed, by label, and of agreement along each kind of edge."""

    def __init__(self, node: np.ndarray, edge: np.ndarray):
        self.node, self.edge = node, edge

    def scores(self, x: np.ndarray, form: np.ndarray, label: np.ndarray) -> np.ndarray:
        score = np.where(_CAN[form], x @ self.node, -30.0)
        held = label > 0
        score[held] = -30.0
        score[held, label[held]] = 30.0
        return score

    def beliefs(self, score: np.ndarray, links: list[tuple[int, int, int]]) -> np.ndarray:
        """Label probabilities by damped loopy message passing until it settles. On loops of strong edges they are too sure of
        the best label, which they keep."""
        score = score.copy()
        if links:
            a, b, kind = np.array(links).T
            src, dst = np.concatenate([a, b]), np.concatenate([b, a])
            w = np.eye(_K)[None] * self.edge[np.concatenate([kind, kind])][:, None, None]
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            m = np.zeros((len(src), _K))
            for _ in range(_ROUNDS):
                total = score.copy()
                np.add.at(total, dst, m)
                into = (total[src] - m[back])[:, :, None] + w
                top = into.max(axis=1, keepdims=True)
                new = top[:, 0] + np.log(np.exp(into - top).sum(axis=1))
                old, m = m, _DAMP * m + (1 - _DAMP) * (new - new.max(axis=1, keepdims=True))
                if np.abs(m - old).max() < _CHANGE:
                    break
            np.add.at(score, dst, m)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


#: Labelled texts that the field is fitted to: made here, by rule, from a fixed seed.
TRAIN_TEXTS = 300
_FILLER = "the and of a then now see here also we was with it again later both note that as well".split()


def training_text(rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A text and ``start, end, label`` of its personal mentions: things named once to fifty times, in forms that the base rules see or not,
    with or without words that speak for them, among numbers and addresses that belong to nobody and repeat as often."""
    pick = lambda some: some[rng.integers(0, len(some))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    often = lambda: int(pick([1, 1, 1, 2, 2, 3, 5, 12, 50]))
    said: list[tuple[str, str, int]] = []  # words before, the mention, its label

    def cue(kind: str, chance: float) -> str:
        return pick(CUES[kind].split()) + pick([" ", ": ", " is "]) if rng.random() < chance else ""

    def card(good: bool) -> str:
        while True:
            d = pick("3456") + digits(15)
            if luhn(d) == good:
                return d

    for _ in range(rng.integers(1, 4)):
        kind = KINDS[rng.integers(0, 4)]
        label = 1 + KINDS.index(kind)
        if kind == "email":
            user, host = f"{pick(['ann', 'joe', 'li', 'x'])}.{digits(3)}", f"mail{digits(2)}.{pick(['example', 'test'])}.{pick(['com', 'org', 'net'])}"
            plain = f"{user}@{host}"
            loose = [f"{user} (at) {host}", f"{user}[at]{host}", f"{user} at {host.replace('.', ' dot ')}", f"{user} @ {host}", f"{user} at {host}"]
        elif kind == "ip":
            parts = [str(v) for v in rng.integers(1, 256, 4)]
            plain, loose = ".".join(parts), ["[.]".join(parts), " . ".join(parts), "(.)".join(parts), "[dot]".join(parts)]
        elif kind == "card":
            plain = card(True)
            four = [plain[k : k + 4] for k in range(0, 16, 4)]
            loose = [".".join(four), "/".join(four), " - ".join(four)]
        else:
            d = pick("123456789") + digits(int(pick([9, 10, 11])))
            plain, loose = f"+{d[0]} ({d[1:4]}) {d[4:7]}-{d[7:]}", [d, f"{d[0]}/{d[1:4]}/{d[4:7]}/{d[7:]}", f"{d[0]}.{d[1:4]}.{d[4:]}", f"{d[0]}-{d[1:4]}-{d[4:7]}-{d[7:]}", f"{d[1:4]}-{d[4:7]}-{d[7:]}", f"0{d[1:4]} {d[4:]}"]
        form = pick(loose)
        seen = rng.random() < 0.7
        if seen:
            said += [(cue(kind, 0.3), plain, label)] * int(pick([1, 1, 2]))
        repeats = [(cue(kind, 0.2 if seen else 0.9), form if rng.random() < 0.8 else pick(loose), label) for _ in range(often())]
        if not seen:
            repeats[0] = (cue(kind, 1.0), form, label)
        said += repeats if not (seen and rng.random() < 0.2) else []
        if rng.random() < 0.3 and kind in ("card", "phone"):  # a number beside it that differs by one digit
            k = int(rng.integers(1, len(plain) - 1))
            while not plain[k].isdigit():
                k += 1
            other = _NOT_DIGIT.sub("", plain[:k] + str((int(plain[k]) + 1) % 10) + plain[k + 1 :])
            if not (13 <= len(other) <= 19 and luhn(other)):
                said += [(cue("none", 0.5), other, 0)] * int(pick([1, 1, 2, 5]))
    for _ in range(rng.integers(0, 5)):
        nobody = pick([digits(8), "7" + digits(9), "8" + digits(9), "9" + digits(11), card(False), "1" + digits(24), f"{rng.integers(256, 999)}.{digits(2)}.1.2", f"look at www.{pick(['site', 'page'])}{digits(1)}.org", f"{digits(4)}-{digits(2)}-{digits(2)} {digits(2)}"])
        said += [(cue("none", 0.5) if nobody[0].isdigit() else "", nobody, 0)] * often()
    rng.shuffle(said)
    text, found = "", []
    for before, mention, label in ((str(b), str(m), int(y)) for b, m, y in said):
        text += " ".join(pick(_FILLER) for _ in range(rng.integers(2, 5))) + " " + before
        if label:
            found.append((len(text), len(text) + len(mention), label))
        text += mention + pick([", ", ". ", " "])
    return text, found


def _labelled(text: str, found: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    nodes = tokens(text, base_spans(text))
    starts = [a for a, _, _ in found]
    y = []
    for a, b, f, held in nodes:
        k = bisect_left(starts, b) - 1
        inside = k >= 0 and found[k][1] > a and _CAN[f][found[k][2]]
        y.append(held or (found[k][2] if inside else 0))
    return nodes, np.array(y, int)


@lru_cache(maxsize=1)
def fitted(texts: int = TRAIN_TEXTS, steps: int = 1200, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Maximum pseudo-likelihood: each label given its neighbours' labels is a softmax regression, whose weights of agreement are shared by
    all labels."""
    rng = np.random.default_rng(7)
    xs, ys, forms, agree, opens = [], [], [], [], []
    for _ in range(texts):
        text, found = training_text(rng)
        nodes, y = _labelled(text, found)
        if not len(nodes):
            continue
        n = np.zeros((len(nodes), len(EDGES), _K))
        for i, j, kind in edges(text, nodes):
            n[i, kind, y[j]] += 1
            n[j, kind, y[i]] += 1
        xs += [_features(text, a, b, f) for a, b, f, _ in nodes]
        forms += [f for _, _, f, _ in nodes]
        opens += [held == 0 for *_, held in nodes]
        ys.append(y)
        agree.append(n)
    keep = np.array(opens)
    x, y, n, can = np.array(xs)[keep], np.eye(_K)[np.concatenate(ys)[keep]], np.minimum(np.concatenate(agree)[keep], 2), _CAN[np.array(forms)[keep]]
    node, edge = np.zeros((x.shape[1], _K)), np.zeros(len(EDGES))
    node_speed, edge_speed = np.zeros_like(node), np.zeros_like(edge)
    for _ in range(steps):
        s = np.where(can, x @ node + np.einsum("k,nkl->nl", edge, n), -30.0)
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        node_speed = 0.9 * node_speed + x.T @ (y - p) / len(x) - decay * node
        edge_speed = 0.9 * edge_speed + np.einsum("nkl,nl->k", n, y - p) / len(x) - decay * edge
        node, edge = node + rate * node_speed, edge + rate * edge_speed
    return Field(node, edge)


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Tokens that the base rules miss and the field labels with a kind: because they repeat or resemble a base span, or because of their form
    and the words beside them. Spans of a kind do not overlap."""
    nodes = tokens(text, base)
    if all(held for *_, held in nodes):
        return []
    label = np.array([held for *_, held in nodes])
    score = field.scores(np.array([_features(text, a, b, f) for a, b, f, _ in nodes]), np.array([f for _, _, f, _ in nodes]), label)
    p = field.beliefs(score, edges(text, nodes))
    best = p.argmax(axis=1)
    return [(_LABELS[best[v]], a, b) for v, (a, b, _, held) in enumerate(nodes) if not held and best[v] and p[v, best[v]] >= BELIEF]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_spans(docs: DataFrame, *carry: str, text_col: str = "text") -> DataFrame:
    """The columns ``carry`` with ``base`` and ``spans`` of each row: ``kind:start:end``, by kind in the order of ``KINDS``, then
    start, joined by commas; offsets count code points, ends are exclusive. ``spans`` has the base spans and those that the
    field adds. Null and empty texts have none. Rows are independent; nothing is shuffled."""
    field = fitted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = [], []
            for t in batch.column(text_col):
                text = t.as_py() or ""
                found = base_spans(text)
                base.append(_written(found))
                spans.append(_written(found + more) if (more := added_spans(text, found, field)) else base[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(base, pa.string()), pa.array(spans, pa.string())], [*carry, "base", "spans"])

    source = docs.select(*dict.fromkeys([*carry, text_col]))
    schema = source.select(*carry, F.lit("").alias("base"), F.lit("").alias("spans")).schema
    return source.mapInArrow(run, schema)


def pii_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, ``base_sha256`` of the base spans as written, and all ``spans``."""
    found = find_spans(docs.select("doc_id", "text"), "doc_id")
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def masked_text(text: str, spans: list[Span]) -> str:
    """``text`` with each covered stretch replaced by the upper-case kind, in angle brackets, of the span that begins it.
    Overlapping spans are one stretch."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of each text masked. Null texts stay null; other columns and rows stay as they are."""
    field = fitted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = []
            for t in batch.column(k):
                text = t.as_py()
                base = base_spans(text) if text else []
                found = base + added_spans(text, base, field) if text else []
                texts.append(masked_text(text, found) if found else text)
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return docs.mapInArrow(run, docs.schema)
