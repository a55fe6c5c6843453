"""Plain versions of the alignment, the prefix trie and the patterns of personal data."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict


def alignment(rows, path_a, path_b):
    """Whole texts by the libraries; one tuple per row in the query's column order."""
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a_model = Tokenizer.from_file(path_a)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    found, counts = [], Counter()
    for doc_id, text in rows:
        groups, a, b = [], [], []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            sides = [
                [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a],
                [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b],
            ]
            if any(b"".join(side) != (" " + text).encode() for side in sides):
                a, b = [], []
            else:
                ends = []
                for side in sides:
                    at, place = 0, {}
                    for i, token in enumerate(side, 1):
                        at += len(token)
                        place[at] = i
                    ends.append(place)
                from_a = from_b = 0
                for end in sorted(ends[0].keys() & ends[1].keys()):
                    groups.append((a[from_a : ends[0][end]], b[from_b : ends[1][end]]))
                    from_a, from_b = ends[0][end], ends[1][end]
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        n_best = sum(counts[link] == best[link[1]] for link in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[link] for link in links), digest))
    return out


def trie(rows):
    """Nodes of rebuilt conversations, from rows of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    built = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        root = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(root, [])[:h] + own[c][h:]
        for depth in range(len(built[c]) + 1):
            nodes[tuple(built[c][:depth])].append(c)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    sums, out = {}, []
    for node in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [sums[x] for x in children[node]]
        sums[node] = (sum(x[0] for x in below) or 1, (len(nodes[node]) - 1) * words + sum(x[1] for x in below))
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in members if len(built[c]) == len(node))
        parent = nodes[node[:-1]][0] if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((members[0], len(node), parent, len(members), len(children[node]), *sums[node], digest))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data(text):
    """(start, rank, end, kind) of all matches that pass their tests."""
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text):
            value = match.group()
            digits = [int(c) for c in value if c.isascii() and c.isdigit()]
            twice = [x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in value.split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and sum(twice) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((match.start(), rank, match.end(), kind))
    return sorted(out)
