"""Personal data by fixed patterns and a semi-Markov conditional random field.

Base spans are the matches of four patterns (``KINDS``), each non-overlapping from
the left, that pass their check. The field adds spans the patterns miss, such as
phone numbers without a plus sign or addresses with a written-out at sign.

1. Candidates. Around digits and at signs a text has candidate segments: spans of
   at most ``GROUPS`` digit groups, or of an at sign with its neighbours. All else
   is outside, in segments of one place and score 0.
2. Features look at the whole candidate: how many digits in which groups, which
   separators, checksums, ranges, labels of a host, what stands on either side.
3. A segmentation's score is the sum over its segments. Training maximises the
   likelihood of known segmentations (sums over all segmentations by the forward
   and backward recursions); decoding takes the best one, so boundaries and kinds
   are chosen together and segments never overlap.
4. The field learns from a bounded sample of documents, whose base spans are known,
   and from their words around made-up entities and look-alikes (dates, versions,
   prices, numbers that fail a check). It is fitted on the driver; Spark sends the
   weights to the tasks, which read every text in full.

Offsets count code points. An added span that overlaps a base span is dropped;
counts and the digest are those of the base spans. Defined cases: a null or empty
text has no spans; repeated rows are treated alike; an empty table gives no rows
and the field is then fitted on made-up words.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import body, table, text_chunks

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Digit groups in a candidate at most, and labels of a host.
GROUPS, LABELS = 8, 6
#: Documents of the sample, made-up snippets, rounds and strength of regularisation.
FIT_DOCS, MADE, ROUNDS, DECAY = 2000, 2400, 40, 0.02

# The contract's patterns. They are entered only where a match can
# start, and never tried again within a run, so long runs cost linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CLOSED = {"+": "", "(": ")", "[": "]"}
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(parts) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass, sorted."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        size = len(before) - len(before.rstrip(LOCAL))
        host = _HOST.match(text, at + 1) if size else None
        if host:
            found.append((at - size, EMAIL, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if octets(m.group().split(".")):
            found.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


#: Texts without any of this hold no span (RE2 syntax, for whole columns at once).
TRIGGER = r"[0-9@]|(?i:[(\[{] ?at ?[)\]}]| at .* dot )"
_ZONE = re.compile(r"[+(\[]{0,2}[0-9](?:[\x20.()\[\]/+-]{0,3}[0-9]){3,}")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20at\x20|\x20?@\x20?", re.I)
_DOT = re.compile(r"\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\x20dot\x20|\.", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_WORD = re.compile(r"[^\W\d_]+\W*\Z")


def _side(c: str) -> str:
    if not c:
        return "edge"
    if c in "0123456789":
        return "9"
    return "a" if c.isalpha() else "_" if c.isspace() else c if c in "+-.()[]/@:,=\"" else "?"


def candidates(text: str) -> list[tuple[int, int, int, list[str]]]:
    """(start, end, kind, features) of all candidate segments, by end."""
    out: list[tuple[int, int, int, list[str]]] = []
    for zone in _ZONE.finditer(text):
        groups = [m.span() for m in _DIGITS.finditer(text, zone.start(), zone.end())]
        for i, (first, _) in enumerate(groups):
            n, parts = 0, []
            for s, e in groups[i:i + GROUPS]:
                n += e - s
                if n > 19:
                    break
                parts.append(text[s:e])
                kinds = ([IP] if len(parts) == 4 else []) + ([CARD] if n >= 12 else []) + ([PHONE] if 7 <= n <= 15 else [])
                if not kinds:
                    continue
                starts = [first]  # and with what leads in; a bracket only where it is closed
                while starts[-1] > zone.start() and CLOSED.get(text[starts[-1] - 1], "!") in text[first:e]:
                    starts.append(starts[-1] - 1)
                for start in starts:
                    shared = _number_features(text, start, e, parts, n)
                    out.extend((start, e, k, [f"{k}{f}" for f in shared]) for k in kinds)
    for m in _AT.finditer(text):
        before = text[max(0, m.start() - 64):m.start()]
        size = len(before) - len(before.rstrip(LOCAL))
        if not size:
            continue
        label, labels, dots = _LABEL.match(text, m.end()), 1, []
        while label and labels < LABELS:
            dot = _DOT.match(text, label.end())
            label = _LABEL.match(text, dot.end()) if dot else None
            if label:
                labels += 1
                dots.append(dot.group().strip().lower())
                start = m.start() - size
                out.append((start, label.end(), EMAIL, [f"{EMAIL}{f}" for f in _address_features(
                    text, start, label.end(), m.group(), dots, label.group(), size)]))
    return sorted(out, key=lambda c: (c[1], c[0], c[2]))


def _sides(text: str, start: int, end: int) -> list[str]:
    left, right = text[max(0, start - 1):start], text[end:end + 1]
    after = text[end + 1:end + 2]
    word = _WORD.search(text[max(0, start - 24):start])
    before = text[max(0, start - 2):max(0, start - 1)]
    return ["l" + _side(left), "r" + _side(right), f"rr{_side(right)}{_side(after)}", f"ll{_side(before)}{_side(left)}",
            "w" + (re.sub(r"\W", "", word.group()).lower()[-12:] if word else "")]


def _number_features(text: str, start: int, end: int, parts: list[str], n: int) -> list[str]:
    span = text[start:end]
    gaps = _DIGITS.sub(" ", span).split(" ") if " " not in span else _DIGITS.sub("|", span).split("|")
    inner = [g for g in gaps[1:-1]]
    seps = sorted(set(inner))
    sizes = "-".join(str(min(len(p), 17)) for p in parts)
    out = ["bias", f"n{n}", f"g{sizes}", f"k{len(parts)}", "s" + "|".join(seps), f"first{gaps[0]}", f"u{len(seps) < 2}",
           f"g{sizes}s{'|'.join(inner)}", f"zero{parts[0][0] == '0'}"]
    if len(parts) == 4:
        out.append(f"octets{octets(parts)}" + "|".join(seps))
    if n >= 12:
        out.append(f"luhn{luhn(''.join(parts))}")
    if parts[0] in ("00", "001"):
        out.append("abroad")
    return out + _sides(text, start, end)


def _address_features(text, start, end, at, dots, last, size) -> list[str]:
    form = at.strip().lower() or at
    return ["bias", "at" + form.replace(" ", ""), "gap" + str(at.count(" ")), "dots" + "|".join(sorted(set(dots))), f"labels{len(dots) + 1}",
            f"last{last.isalpha()}{min(len(last), 7)}", f"local{min(size, 4)}", f"at{form}dots{'|'.join(sorted(set(dots)))}",
            *_sides(text, start, end)]


class Lattice:
    """Candidate segments of one text between its places."""

    def __init__(self, found, gold=()):
        self.places = sorted({p for s, e, _, _ in found for p in (s, e)})
        self.start = [bisect_left(self.places, c[0]) for c in found]
        self.end = [bisect_left(self.places, c[1]) for c in found]
        gold = set(gold)
        self.gold = np.array([(c[0], c[2], c[1]) in gold for c in found], bool)

    def marginals(self, score: list[float]) -> tuple[float, np.ndarray]:
        """The log of the sum over all segmentations, and each candidate's probability."""
        n = len(self.places)
        into: list[list[int]] = [[] for _ in range(n)]
        out: list[list[int]] = [[] for _ in range(n)]
        for c, (s, e) in enumerate(zip(self.start, self.end, strict=True)):
            into[e].append(c)
            out[s].append(c)
        forward, backward = [0.0] * n, [0.0] * n
        for t in range(1, n):
            forward[t] = _log_sum([forward[t - 1], *(forward[self.start[c]] + score[c] for c in into[t])])
        for t in range(n - 2, -1, -1):
            backward[t] = _log_sum([backward[t + 1], *(backward[self.end[c]] + score[c] for c in out[t])])
        total = forward[-1] if n else 0.0
        p = [math.exp(min(0.0, forward[s] + x + backward[e] - total)) for s, e, x in zip(self.start, self.end, score, strict=True)]
        return total, np.array(p)

    def best(self, score: list[float]) -> list[int]:
        """The candidates of the best segmentation. They are in the order of their ends."""
        n, c = len(self.places), 0
        value, taken = [0.0] * n, [-1] * n
        for t in range(1, n):
            value[t] = value[t - 1]
            while c < len(score) and self.end[c] == t:
                v = value[self.start[c]] + score[c]
                if v > value[t]:
                    value[t], taken[t] = v, c
                c += 1
        found, t = [], n - 1
        while t > 0:
            if taken[t] >= 0:
                found.append(taken[t])
                t = self.start[taken[t]]
            else:
                t -= 1
        return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if len(values) > 1 else top


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = ROUNDS, decay: float = DECAY) -> dict[str, float]:
    """Feature weights from (text, known spans): full gradients with a step of their own for each weight."""
    names: dict[str, int] = {}
    lattices, ids, owner = [], [], []
    n = 0
    for text, gold in examples:
        found = candidates(text)
        if not found:
            continue
        lattices.append(Lattice(found, gold))
        for c in found:
            f = [names.setdefault(x, len(names)) for x in c[3]]
            ids.extend(f)
            owner.extend([n] * len(f))
            n += 1
    if not n:
        return {}
    ids, owner = np.array(ids), np.array(owner)
    gold = np.concatenate([x.gold for x in lattices]).astype(float)
    ends = np.cumsum([len(x.gold) for x in lattices])
    w, past = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(rounds):
        score = np.bincount(owner, weights=w[ids], minlength=n).tolist()
        p = np.concatenate([x.marginals(score[e - len(x.gold):e])[1] for x, e in zip(lattices, ends.tolist(), strict=True)])
        grad = np.bincount(ids, weights=(gold - p)[owner], minlength=len(w)) - decay * w
        past += grad * grad
        w = w + 0.6 * grad / np.sqrt(past)
    return {x: float(w[i]) for x, i in names.items() if abs(w[i]) > 1e-3}


def added_spans(text: str, weights: dict[str, float], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the best segmentation's segments that overlap no base span."""
    found = candidates(text)
    if not found:
        return []
    score = [sum(weights.get(f, 0.0) for f in c[3]) for c in found]
    spans = [(found[c][0], found[c][2], found[c][1]) for c in Lattice(found).best(score)]
    ends = np.maximum.accumulate([b[2] for b in base]).tolist()
    starts = [b[0] for b in base]
    out = []
    for s, k, e in spans:
        at = bisect_left(starts, e)  # base spans that start before this one ends
        if not at or ends[at - 1] <= s:
            out.append((s, k, e))
    return out


class Maker:
    """Made-up entities and look-alikes in the words of a corpus."""

    def __init__(self, words: list[str], seed: int = 1):
        self.r, self.words = random.Random(seed), words or ["word"]

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def name(self) -> str:
        return "".join(self.r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.r.randint(2, 9)))

    def email(self) -> str:
        r = self.r
        at = r.choice(["@", "@", " @ ", " (at) ", "[at]", " at ", "(at)", " [at] "])
        dot = r.choice([".", " dot ", "(dot)", "[dot]", " [dot] "]) if at != "@" else "."
        if at == " at ":
            dot = " dot "  # a plain "at" before a plain host is prose
        local = self.name() + r.choice(["", "." + self.name(), str(r.randint(1, 99)), "_" + self.name()])
        return local + at + dot.join([self.name() + r.choice(["", str(r.randint(1, 9))]), *([self.name()] if r.random() < 0.4 else []),
                                      r.choice(["com", "org", "net", "de", "io", "info"])])

    def ip(self) -> str:
        parts = [str(self.r.randint(0, 255)) for _ in range(4)]
        return self.r.choice([".", ".", "[.]", "(.)", " . "]).join(parts)

    def card(self, valid: bool = True) -> str:
        n = self.r.choice([16, 16, 16, 15, 13, 19])
        d = self.digits(n - 1)
        last = next(c for c in "0123456789" if luhn(d + c) == valid)
        d = self.r.choice("3456") + d[1:]
        last = next(c for c in "0123456789" if luhn(d + c) == valid)
        d += last
        return self.r.choice(["", " ", "-", ".", "/"]).join(d[i:i + 4] for i in range(0, n, 4)) if self.r.random() < 0.7 else d

    def phone(self) -> str:
        d, r = self.digits, self.r
        a, b, c = str(r.randint(2, 9)) + d(2), d(3), d(4)
        return r.choice([f"+{r.randint(1, 99)} ({a}) {b}-{c}", f"+{r.randint(1, 99)}-{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
                         f"{a}.{b}.{c}", f"({a}) {b} {c}", f"00{r.randint(1, 49)} {a} {b} {c}", f"1-{a}-{b}-{c}", f"({a}){b}-{c}"])

    def look_alike(self) -> str:
        d, r = self.digits, self.r
        return r.choice([
            f"{r.randint(1900, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{r.randint(1, 28):02d}.{r.randint(1, 12):02d}.{r.randint(1900, 2030)}",
            f"{r.randint(1, 12):02d}/{r.randint(1, 28):02d}/{r.randint(1900, 2030)} {r.randint(0, 23):02d}:{d(2)}:{d(2)}",
            f"{r.randint(0, 20)}.{r.randint(0, 20)}.{r.randint(0, 99)}", f"{r.randint(256, 999)}.{r.randint(256, 999)}.{d(2)}.{d(1)}",
            f"{r.randint(1, 999)},{d(3)},{d(3)}.{d(2)}", f"{r.randint(1, 9999)}.{d(5)}", d(r.randint(7, 11)), d(r.randint(20, 30)), self.card(valid=False),
            f"{d(4)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"{r.randint(1900, 2030)}-{r.randint(1900, 2030)} {d(4)}", " ".join(d(r.randint(1, 3)) for _ in range(6)),
            " ".join(f"{r.randint(1, 99)}.{d(2)}" for _ in range(4)), f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"0.{d(9)}", f"{d(8)} {d(8)}",
            "%030x" % r.getrandbits(120), f"{self.name()}@{self.name()}", f"{self.name()} at {self.name()}. {self.name()}", f"@{self.name()} {self.name()}.{self.name()}",
            f"{self.name()} at {self.name()}.{self.name()} {self.name()}", f"{r.randint(1, 99)} . {r.randint(1, 99)} - {d(7)}", f"{d(4)} {d(4)} {d(4)}"])

    def snippet(self) -> tuple[str, list[tuple[int, int, int]]]:
        r = self.r
        text, spans = " ".join(r.choices(self.words, k=r.randint(0, 8))), []
        for _ in range(r.choice([1, 1, 2])):
            lead = r.choice([" ", " ", " ", "\n", ": ", " (", ", ", " \""])
            if not text and r.random() < 0.5:
                lead = ""
            elif r.random() < 0.15:
                lead = r.choice([" tel ", " call ", " card ", " ip ", " mail ", " phone: ", " host "])
            kind = r.choice([*range(4), *range(4), None, None, None, None, None])
            made = self.look_alike() if kind is None else (self.email, self.ip, self.card, self.phone)[kind]()
            text += lead
            if kind is not None:
                spans.append((len(text), kind, len(text) + len(made)))
            text += made
            if r.random() < 0.1:
                break
            text += r.choice([" ", " ", ".", ", ", ")", "!! ", "\n", "\"", "; ", "&&& "])
            text += " ".join(r.choices(self.words, k=r.randint(1, 6)))
        return text, spans


def known(text: str, spans) -> list[tuple[int, int, int]]:
    """The spans to learn: given ones, and base spans that overlap none of them."""
    base = [b for b in base_spans(text) if all(b[2] <= s or e <= b[0] for s, _, e in spans)]
    out: list[tuple[int, int, int]] = []
    for b in sorted([*spans, *base]):
        if not out or out[-1][2] <= b[0]:
            out.append(b)
    return out


def sample(docs: DataFrame, rows: int = FIT_DOCS) -> list[str]:
    """The texts of the ``rows`` documents with the least hash of their id; of a
    repeated id the least text."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct()
    picked = ids.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), body(F.col("text")).alias("text"))
    # ``rows`` ids of 8 bytes: a broadcast of a proven size
    got = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text")).collect()
    return [r["text"] for r in sorted(got)]


def train(texts: list[str], made: int = MADE, rounds: int = ROUNDS) -> dict[str, float]:
    """The field's weights from the texts of a sample."""
    words = [w for t in texts[:200] for w in t.split()[:200] if not any(c in "0123456789@" for c in w)]
    maker = Maker(words)
    examples = [(t, known(t, spans)) for t, spans in (maker.snippet() for _ in range(made))]
    examples += [(t, known(t, [])) for t in texts if re.search("[0-9@]", t)]
    return fit(examples, rounds)


def pii(docs: DataFrame, rows: int = FIT_DOCS) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans``, a row per row of ``docs``;
    ``base`` and ``spans`` list kind:start:end by start, then kind."""
    weights = train(sample(docs, rows))

    def listed(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for chunk in text_chunks(batches):
            n = chunk.num_rows
            base, every = [""] * n, [""] * n
            counts = np.zeros((4, n), np.int64)
            column = chunk.column("text")
            on = np.flatnonzero(pc.match_substring_regex(column, TRIGGER).to_numpy(zero_copy_only=False))
            for i, text in zip(on.tolist(), column.take(pa.array(on)).to_pylist(), strict=True):
                spans = base_spans(text)
                base[i] = listed(spans)
                for _, k, _ in spans:
                    counts[k, i] += 1
                every[i] = listed(sorted(spans + added_spans(text, weights, spans)))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), *(pa.array(c) for c in counts), pa.array(base, pa.string()), pa.array(every, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(F.col("text")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
