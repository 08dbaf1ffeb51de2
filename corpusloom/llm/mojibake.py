"""Problem 10: text read with a wrong character encoding, found and restored.

A multinomial classifier over hashed byte bigrams is fitted to sentences of a bounded sample, right ones and the same
ones garbled by every chain of encodings in CHAINS. Each sentence with letters beyond ASCII is scored; the most likely
chain whose inverse is strictly decodable is inverted. A garbled sign that stands alone in an otherwise plain sentence is
a quotation, and left, unless the text has garbled sentences of the same chain. A text with replacement characters has
lost letters and cannot be restored.

Defined cases: null and empty texts are no cases; texts without two neighbouring signs beyond ASCII, or one of East
Asia, cannot be garbled by these chains and are never read by Python; a text is judged sentence by
sentence, whole, whatever its length; copies are each reported; with an empty sample nothing but lost text is found.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import ship_package

#: Bound of the sample that the classifier is fitted to, in texts, and sentences of each language's share.
TRAIN_TEXTS = 1500
BUCKETS = 1 << 13
#: How much more likely a right sentence is than one of each chain, as a log ratio.
PRIOR = 4.0
LOST = "�"

# Encodings that UTF-8 was read as. "cp1252" lets the control signs of Latin-1 through when it is inverted.
WRONG = ("cp1252", "latin1", "iso8859_15", "iso8859_2", "cp1251", "mac_roman", "cp437")
# Encodings that are tried as the only step of a chain, too.
RARE = ("cp1250", "cp850", "gbk", "shift_jis")
# Fixed values: (written in, read as) for one-byte encodings of Cyrillic.
ONE_BYTE = (("cp1251", "cp1252"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"))
#: A chain lists the steps in the order in which the text was garbled.
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = tuple(
    [(("utf_8", a),) for a in WRONG + RARE]
    + [(("utf_8", a), ("utf_8", b)) for a, b in product(WRONG, WRONG)]
    + [(("utf_8", a),) * 3 for a in ("cp1252", "latin1")]
    + [(p,) for p in ONE_BYTE]
)
_SENTENCES = re.compile(r"((?<=[.!?:…]) |\n)")
_RUNS = re.compile(r"[^\x00-\x7f]+")
_CYRILLIC = re.compile(r"[Ѐ-ӿ]")
_PAIR = re.compile(r"[^\x00-\x7f]{2}|[぀-鿿｡-ﾟ]")  # a garbled sign is two or more, or one of East Asia
_DENSE = re.compile(r"[A-Za-z](?:[^\x00-\x7f]{2}|[぀-鿿｡-ﾟ])|(?:[^\x00-\x7f]{2}|[぀-鿿｡-ﾟ])[A-Za-z]")  # letters beside garbled signs


def _encode(s: str, codec: str) -> bytes:
    """Strict, but signs without a place in a Windows code page pass as their own byte, as browsers write them."""
    try:
        return s.encode(codec)
    except UnicodeEncodeError:
        if codec not in ("cp1252", "cp1251"):
            raise
        out = bytearray()
        for ch in s:
            try:
                out += ch.encode(codec)
            except UnicodeEncodeError:
                if not 0x80 <= ord(ch) <= 0x9F:
                    raise
                out.append(ord(ch))
        return bytes(out)


def _decode(b: bytes, codec: str) -> str:
    if codec in ("cp1252", "cp1251"):
        try:
            return b.decode(codec)
        except UnicodeDecodeError:
            return "".join(chr(x) if 0x80 <= x <= 0x9F and not _has(x, codec) else bytes([x]).decode(codec) for x in b)
    return b.decode(codec)


def _has(x: int, codec: str) -> bool:
    try:
        bytes([x]).decode(codec)
        return True
    except UnicodeDecodeError:
        return False


def garble(s: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text as the chain's readers saw it; None where a step cannot write it."""
    try:
        for written_in, read_as in chain:
            s = _decode(_encode(s, written_in), read_as)
    except UnicodeError:
        return None
    return s


def invert(s: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text before the chain; None where it isn't strictly decodable."""
    try:
        for written_in, read_as in reversed(chain):
            before = _decode(_encode(s, read_as), written_in) if written_in != "utf_8" else _encode(s, read_as).decode("utf_8")
            if before == s:
                return None
            s = before
    except UnicodeError:
        return None
    return s


def bigrams(s: str) -> np.ndarray:
    """Hash buckets of the byte bigrams that have a byte beyond ASCII."""
    b = np.frombuffer(s.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    pair = (b[:-1] << np.uint32(8)) | b[1:]
    pair = pair[(b[:-1] > 127) | (b[1:] > 127)]
    return ((pair * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def suspects(s: str) -> list[int]:
    """Numbers of the chains whose inverse is strictly decodable for the sentence."""
    out, first = [], {}
    for a in WRONG + RARE:
        if (t := invert(s, (("utf_8", a),))) is not None:
            first[a] = t
    for n, chain in enumerate(CHAINS):
        last = chain[-1]
        if last[0] == "utf_8":
            if last[1] in first and (len(chain) == 1 or invert(first[last[1]], chain[:-1]) is not None):
                out.append(n)
        elif last == ("cp1251", "cp1252"):
            if invert(s, chain) is not None:
                out.append(n)
        elif _CYRILLIC.search(s):
            upper = sum(c.isupper() for c in s if c > "\x7f")
            if 2 * upper > sum(c.isalpha() for c in s if c > "\x7f") and invert(s, chain) is not None:
                out.append(n)
    return out


def train(texts: list[str]) -> np.ndarray:
    """Log probabilities (chains + 1) x BUCKETS, right text last.

    A chain works sign by sign, so the words of the right sentences are counted and each distinct word is garbled once.
    """
    words: Counter[str] = Counter()
    for text in texts:
        for s in _SENTENCES.split(text):
            if s and not s.isascii() and LOST not in s and not any(CHAINS[n][-1][0] == "utf_8" for n in suspects(s)):
                words.update(w for w in s.split(" ") if not w.isascii())
    counts = np.full((len(CHAINS) + 1, BUCKETS), 0.1)
    for w, times in words.items():
        w = f" {w} "
        np.add.at(counts[-1], bigrams(w), times)
        for n, chain in enumerate(CHAINS):
            if chain[0][0] != "utf_8" and not _CYRILLIC.search(w):
                continue
            if (g := garble(w, chain)) is not None and g != w:
                np.add.at(counts[n], bigrams(g), times)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _alone(s: str, chain: tuple[tuple[str, str], ...]) -> bool:
    """True if all that is garbled are single signs or two that no letter or digit touches."""
    runs = [(m.span(), t) for m in _RUNS.finditer(s) if (t := invert(m.group(), chain)) is not None]
    return bool(runs) and all(len(t) <= 2 and not (s[a - 1 : a].isalnum() or s[b : b + 1].isalnum()) for (a, b), t in runs)


def scores(s: str, logp: np.ndarray) -> dict[int, float]:
    """For each chain under which the sentence is likelier than as right text: its log likelihood, with that of the result as right text."""
    if not _PAIR.search(s) or not (maybe := suspects(s)):
        return {}
    seen = logp[:, bigrams(s)].sum(axis=1)
    return {n: float(seen[n] + logp[-1, bigrams(invert(s, CHAINS[n]))].sum()) for n in maybe if seen[n] > seen[-1] + PRIOR}


def _deeper(s: str, logp: np.ndarray) -> str:
    """What is left of a longer chain is inverted too."""
    # every inversion leaves fewer or other signs, so this ends; a sentence met again would go round
    met = {s}
    while (more := scores(s, logp)) and not _alone(s, CHAINS[n := max(more, key=more.get)]):
        s = invert(s, CHAINS[n])
        if s in met:
            break
        met.add(s)
    return s


def _mixed(s: str, logp: np.ndarray) -> str | None:
    """A sentence that runs into a garbled one, restored word by word; None if no word of letters is garbled."""
    words = s.split(" ")
    found = {i: v for i, w in enumerate(words) if not w.isascii() and (v := scores(f" {w} ", logp))}
    sure = [i for i, v in found.items() if not _alone(words[i], CHAINS[max(v, key=v.get)])]
    if not sure:
        return None
    main = max({n for i in sure for n in found[i]}, key=lambda n: sum(max(found[i].get(n, -1e9) - max(found[i].values()), -40.0) for i in sure))
    for i, w in enumerate(words):
        if not w.isascii() and (t := invert(w, CHAINS[main])) is not None:
            words[i] = t
    return " ".join(words)


def restore(text: str, logp: np.ndarray) -> str | None:
    """The restored text, LOST if letters are destroyed, or None if nothing is garbled.

    The sentences that are surely garbled agree on the chain that is likeliest for all of them; it is inverted wherever it
    is strictly decodable. Signs that stand alone are restored only if all sentences of the text that have such signs are garbled.
    """
    if LOST in text:
        return LOST
    parts = _SENTENCES.split(text)
    wide = [k for k, s in enumerate(parts) if s and not s.isascii()]
    likely = {k: scores(parts[k], logp) for k in wide}
    best = {k: max(v, key=v.get) for k, v in likely.items() if v}
    alone = {k: _alone(parts[k], CHAINS[n]) for k, n in best.items()}
    sure = [k for k in best if not alone[k]]
    mixed = {k: t for k in wide if k not in best and _DENSE.search(parts[k]) and (t := _mixed(parts[k], logp)) is not None}
    if not sure and not mixed:
        return None
    if sure:
        chains = {n for k in sure for n in likely[k]}
        main = max(chains, key=lambda n: sum(max(likely[k].get(n, -1e9) - likely[k][best[k]], -40.0) for k in sure))
        inverse = {k: invert(parts[k], CHAINS[main]) for k in wide}
        whole = all(t is not None for t in inverse.values())
        one_byte = CHAINS[main][-1][0] != "utf_8"
    for k in wide:
        s = inverse[k] if sure else None
        if s is None:
            s = invert(parts[k], CHAINS[best[k]]) if k in best and not alone[k] else mixed.get(k)
        elif k not in best and one_byte and not whole:
            s = None
        elif (alone[k] if k in best else _alone(parts[k], CHAINS[main])) and not whole:
            s = None
        if s is not None:
            parts[k] = _deeper(s, logp)
    return "".join(parts)


def fit(documents: DataFrame, texts: int = TRAIN_TEXTS) -> np.ndarray:
    """A classifier fitted to `texts` non-ASCII texts of `documents` (doc_id, text), those with the smallest id hashes, more or less."""
    wide = documents.where(F.col("text").rlike("[^\\x00-\\x7f]"))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    total = wide.count()
    cut = (1 << 30) if total <= texts else int((1 << 30) * texts / total)
    rows = wide.where(h < cut).select(h.alias("h"), "doc_id", "text").limit(2 * texts).collect()
    return train([r.text for r in sorted(rows, key=lambda r: (r.h, r.doc_id))[:texts]])


def restored(documents: DataFrame, logp: np.ndarray | None = None) -> DataFrame:
    """(doc_id, restored, restored_md5) of every garbled document; restored is null and the md5 `lost` where letters were destroyed."""
    ship_package(documents.sparkSession)
    docs = documents.select("doc_id", "text")
    logp = fit(docs) if logp is None else logp
    kind = documents.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out, md5 = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                r = restore(t, logp)
                if r is not None:
                    at.append(i)
                    out.append(None if r == LOST else r)
                    md5.append("lost" if r == LOST else hashlib.md5(r.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(out, pa.string()), pa.array(md5, pa.string())], names=["doc_id", "restored", "restored_md5"])

    return docs.where(F.col("text").rlike(r"[^\x00-\x7f]{2}|[\x{3040}-\x{9fff}\x{ff61}-\x{ff9f}]|" + LOST)).mapInArrow(go, f"doc_id {kind}, restored string, restored_md5 string")
