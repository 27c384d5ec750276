"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import regex
import xxhash

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(spans, names=("assign", "access", "hex")) -> str:
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def secrets(doc_id, text) -> tuple:
    spans = base_spans(text or "")
    return (doc_id, *[sum(k == j for _, k, _ in spans) for j in range(3)], hashlib.sha256(listed(spans).encode()).hexdigest())


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: list[tuple]) -> dict:
    """(doc_id, fingerprint) -> the smallest doc_id reachable."""
    rows = [(i, simhash(t)) for i, t in docs]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                group[max(top(a), top(b))] = min(top(a), top(b))
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return {(i, fp): least.get(top(k)) for k, (i, fp) in enumerate(rows)}


def measures(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    space = re.compile(r"[^\x20\x09-\x0D]+")
    words = space.findall(text)
    lines = [x for x in text.split("\n") if space.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen: dict = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    repeated = {p for i, g in enumerate(grams) if seen[g] > 1 for p in (i, i + 1, i + 2)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def repeats(texts: list[bytes], size: int = 400) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each text, by a table of all strings of that size."""
    seen: dict = {}
    for t in texts:
        for i in range(len(t) - size + 1):
            s = t[i:i + size]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        starts = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def nearest(vectors: dict, query: int, k: int = 5) -> list[tuple[int, float]]:
    """(vec_id, cosine) of the k nearest, ties to the smaller id."""
    q = np.array(vectors[query], float)
    scores = []
    for i, v in vectors.items():
        if i != query:
            v = np.array(v, float)
            scores.append((i, float(q @ v / np.sqrt((q @ q) * (v @ v)))))
    return sorted(scores, key=lambda x: (-x[1], x[0]))[:k]


def pieces(text: str | None, tokenizer, capacity: int = 4096) -> list[tuple]:
    """(piece, start, length, crc32) of a text."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    return [(s // capacity, s, len(ids[s:s + capacity]), zlib.crc32(array("I", ids[s:s + capacity]).tobytes())) for s in range(0, len(ids), capacity)]


def tiktoken_encoding(name: str = "byte_bpe_multi_50k.tiktoken"):
    import tiktoken
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe(text: str | None, encoding) -> tuple[int, str, str]:
    ids = encoding.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


# -- personal data: the rules of llm/pii.py, row by row

TITLES_M = "Mr Mister Sir Herr Monsieur Señor Signor Senhor господин Господин Κύριος".split()
TITLES_F = "Mrs Ms Miss Madam Lady Frau Madame Mme Mademoiselle Señora Señorita Signora Senhora госпожа Госпожа Κυρία".split()
TITLES_N = "Dr Doctor Prof Professor Doktor Docteur Professeur Doctora Profesora доктор Доктор профессор Профессор".split()
PII_TITLE = "(?:" + "|".join(TITLES_M + TITLES_F + TITLES_N) + ")"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PII_IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?[0-9])"
PII_CARD = "(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
PII_SSN = "(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PII_ANY = regex.compile("|".join([
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?=[A-Za-z0-9-])[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]{2,}", PII_IP, PII_CARD, PII_SSN,
    r"(?<![0-9A-Za-z])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|\+(?:[0-9][ ./-]?|\([0-9]{1,4}\)[ ./-]?){7,14}[0-9])(?![0-9A-Za-z])",
    rf"\b{PII_TITLE}\.?(?:[ ]{PII_TITLE}\.?){{0,3}}(?:[ ]\p{{Lu}}[\p{{L}}'-]*\p{{L}}(?<!'s)){{1,3}}"]))


def digits_of(s):
    return re.sub("[^0-9]", "", s)


def check_sum(digits, upto=0):
    return sum(int(c) if (i + upto) % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))


def pii_kind(s):
    if "@" in s:
        return "email"
    if s[0].isalpha():
        return "person"
    if regex.fullmatch(PII_IP, s):
        return "ip"
    if regex.fullmatch(PII_SSN, s):
        return "ssn"
    if regex.fullmatch(PII_CARD, s):
        d = digits_of(s)
        good = re.match("4|5[1-5]|2[2-7]|3[47]|6(?:011|5)", d) and 13 <= len(d) <= 19 and check_sum(d) % 10 == 0
        return "card" if good else None
    return "phone"


def pii_name(s):
    return regex.sub(rf"^(?:{PII_TITLE}\.?[ ]){{1,4}}(?=.)", "", s)


def pii_cores(s, kind):
    if kind == "person":
        return pii_name(s).split(" ")
    return [s.lower() if kind == "email" else s if kind == "ip" else digits_of(s)[-10:] if kind == "phone" else digits_of(s)]


def pii_gender(s, titles):
    return bool(regex.match(rf"(?:{PII_TITLE}\.?[ ]){{0,3}}(?:{'|'.join(titles)})[. ]", s))


def pii_surrogate(kind, core, gender, draw, key):
    h = hashlib.sha512("\x1f".join([key, kind, core, str(draw)]).encode()).hexdigest()
    n = lambda i: int(h[2 * i % 128:2 * i % 128 + 2], 16)
    letter = lambda alphabet, i: alphabet[n(i) % len(alphabet)]
    if kind == "email":
        local, _, domain = core.rpartition("@")
        body = core.split("@")[0] + "x" * (draw // 4) + "@" + re.sub(r"\.[^.]*$", "", domain)
        return "".join(str(n(i) % 10) if c in "0123456789" else letter("abcdefghijklmnopqrstuvwxyz", i) if "a" <= c <= "z" else c
                       for i, c in enumerate(body)) + ".example"
    if kind == "ip":
        return ".".join(map(str, [n(0) % 126 + 1, n(1), n(2), n(3)]))
    numbers = lambda s: "".join(str(n(i) % 8 + 2 if kind == "phone" and i % 10 in (0, 3) else n(i) % 10) for i in range(len(s)))
    if kind == "card":
        body = core[0] + numbers(core[1:-1])
        return body + str((10 - check_sum(body, 1) % 10) % 10)
    if kind in ("phone", "ssn"):
        return numbers(core)
    script = (("бвгдзклмнпрстфхш", "аеиоу", "а", "н") if regex.search(r"\p{Cyrillic}", core) else
              ("βγδζθκλμνπρστφχ", "αεηιο", "α", "ς") if regex.search(r"\p{Greek}", core) else ("bcdfghjklmnprstvz", "aeiou", "a", "n"))
    size = max(len(core), 4) + draw // 4
    last = {"female": script[2], "male": script[3]}.get(gender) or letter(script[0], size - 1)
    return ("".join(letter(script[i % 2], i) for i in range(size - 1)) + last).capitalize()


def pii(texts: list[str | None], key: str) -> list[str | None]:
    """Each text with its surrogates."""
    hits = [[(m.start(), m.end(), m[0], pii_kind(m[0])) for m in PII_ANY.finditer(t or "")] for t in texts]
    votes: dict = {}
    for found in {t: h for t, h in zip(texts, hits)}.values():
        for _, _, s, kind in found:
            cores = pii_cores(s, kind) if kind else []
            for i, core in enumerate(cores):
                given = kind == "person" and i < len(cores) - 1
                f = given and pii_gender(s, TITLES_F)
                entity = ("name" if kind == "person" else kind, core)
                votes[entity] = votes.get(entity, 0) + f - (given and not f and pii_gender(s, TITLES_M))
    draws = dict.fromkeys(votes, 0)
    while True:
        made = {e: pii_surrogate(*e, "female" if votes[e] > 0 else "male" if votes[e] < 0 else "neutral", d, key) for e, d in draws.items()}
        first: dict = {}
        for (kind, core), s in made.items():
            first[kind, s] = min(first.get((kind, s), (1 << 30, "")), (draws[kind, core], core))
        lost = [e for e in made if (e[0], made[e]) in made or first[e[0], made[e]][1] != e[1]]
        if not lost:
            break
        again = max(draws.values()) + 1
        draws |= dict.fromkeys(lost, again)

    def stand_in(s, kind):
        if kind is None:
            return s
        new = [made["name" if kind == "person" else kind, c] for c in pii_cores(s, kind)]
        if kind == "email":
            return new[0].upper() if s.upper() == s and re.search("[a-z]", s.lower()) else new[0]
        if kind == "ip":
            return new[0]
        if kind == "person":
            return s[:len(s) - len(pii_name(s))] + " ".join(new)
        skip, out, k = len(digits_of(s)) - len(new[0]), "", 0
        for c in s:
            if c in "0123456789":
                out += new[0][k - skip] if k >= skip else c
                k += 1
            else:
                out += c
        return out

    result = []
    for t, found in zip(texts, hits):
        names = {c for _, _, s, kind in found if kind == "person" for c in pii_cores(s, kind)}
        part = regex.compile(r"(?<![\p{L}\p{N}])(?:" + "|".join(sorted(names, key=lambda c: (-len(c), c))) + r")(?![\p{L}\p{N}])") if names else None
        alone = lambda gap: part.sub(lambda m: made["name", m[0]], gap) if part else gap
        out, at = "", 0
        for start, stop, s, kind in found:
            out += alone(t[at:start]) + stand_in(s, kind)
            at = stop
        result.append(t if not found else out + alone(t[at:]))
    return result
