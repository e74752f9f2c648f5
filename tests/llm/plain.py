"""Plain versions of the operators, for small tables."""

import hashlib
import html
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    words = SPLIT.findall(lowered(text))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def smallest_reachable(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def jaccard(docs):
    """doc_id -> (n_shingles, component_id), for distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    label = smallest_reachable(ids, links)
    return {i: (len(sets[i]), label[i]) for i in ids}


def cosine_links(vectors, least=0.9):
    """id -> (n_links, component_id)."""
    unit = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    ids = sorted(unit)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if float(unit[a] @ unit[b]) >= least]
    label = smallest_reachable([i for i, _ in vectors], links)
    return {i: (sum(i in x for x in links), label[i]) for i, _ in vectors}


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (2 if k % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def article(page):
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    body = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\x01", found[1]))) if found else ""
    blocks = [" ".join(html.unescape(x).split()) for x in body.split("\x01")]
    return "\n".join(x for x in blocks if x)


def token_ids(texts, path, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
