"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import sentencepiece
import xxhash
from tokenizers import Tokenizer, pre_tokenizers


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_duplicates(rows: list[tuple]) -> set[tuple]:
    """(doc_id, fingerprint, component_id)."""
    prints = [simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return {(doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)}


def repeated_words(rows: list[tuple], length: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) for rows with ids."""
    seen = defaultdict(list)
    texts = [(doc, (t or "").encode().split()) for doc, t in rows]
    for doc, words in texts:
        for i in range(len(words) - length + 1):
            seen[tuple(words[i : i + length])].append(doc)
    first = {w: min(d) for w, d in seen.items()}
    out = []
    for doc, words in texts:
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < doc:
                gone |= set(range(i, i + length))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def merkle_proofs(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) from (doc_id, source, lang, n_chars, text)."""

    def digest(*parts: str) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(*fields) -> str:
        return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def tree(nodes: list[str]) -> list[list[str]]:
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels: list[list[str]], at: int) -> list[tuple]:
        return [((level[at >> k ^ 1 :] + [None])[0] if at >> k ^ 1 < len(level) else None, at >> k & 1) for k, level in enumerate(levels[:-1])]

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in langs]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, lang in enumerate(langs):
        for at, (_, _, own, row) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            doc, source, _, n_chars, text = row
            changed = doc is not None and n_chars is not None and zlib.crc32(str(doc).encode()) % 7 == 0
            folded = leaf(doc, source, lang, n_chars + 1, text) if changed else own
            steps = path(trees[k], at) + path(top, k)
            for sibling, right in steps:
                folded = digest(*([folded] if sibling is None else [sibling, folded] if right else [folded, sibling]))
            out.append((doc, own, trees[k][-1][0], top[-1][0], digest(*(s for s, _ in steps if s)), folded, folded == top[-1][0]))
    return out


class Alignment:
    """Whole texts, without units and caches."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(i) for i in range(0x800)] + ["\u0800"] + [chr(i << 12) for i in range(1, 16) if i != 13] + ["\ud7ff"] + [chr(i << 18) for i in range(1, 5)] + ["\U00010000"]
        self.sign = {sign: byte for c in letters for sign, byte in zip(signs.pre_tokenize_str(c)[0][0], c.encode(), strict=True)}

    def of(self, text: str | None) -> tuple | None:
        """Ids of both, groups as text and linked occurrences; None without tokens."""
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a = [bytes(self.sign[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        if not b"".join(bytes_a) == f" {text}".encode() == b"".join(bytes_b):
            return None
        a_ends, b_ends = ([sum(map(len, x[: k + 1])) for k in range(len(x))] for x in (bytes_a, bytes_b))
        links = [(x, y) for x, xe, xb in zip(a, a_ends, bytes_a) for y, ye, yb in zip(b, b_ends, bytes_b) if xe - len(xb) < ye and ye - len(yb) < xe]
        groups, last = [], 0
        for end in sorted({*a_ends} & {*b_ends}):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends) if last < e <= end) for ids, ends in ((a, a_ends), (b, b_ends))))
            last = end
        return len(a), len(b), groups, links

    def report(self, rows: list[tuple]) -> list[tuple]:
        found = [(doc, self.of(text)) for doc, text in rows]
        count = Counter(pair for _, x in found if x for pair in set(x[3]))
        best = defaultdict(int)
        for (a, _), n in count.items():
            best[a] = max(best[a], n)
        return [
            (doc, len_a, len_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest()) if x else (doc, 0, 0, 0, 0, 0, 0, "")
            for doc, x in found for len_a, len_b, groups, links in [x or (0, 0, [], [])]]
