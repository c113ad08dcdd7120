"""Plain versions of the dealt operators, and a small table with every awkward case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Extra columns carry names that the operators use inside.
EXTRA = ["unit", "bucket", "row", "token", "domain", "path", "trusted_id", "n", "_kept", "quality", "found_spans", "Taken"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")], T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


def words(text, low=False):
    text = text or ""
    return WORD.findall(lower(text) if low else text)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def prose(seed, n):
    """n words that follow no others by chance."""
    return " ".join(f"w{zlib.crc32(f'{seed}:{k}'.encode()) % 9999}{'é' * (k % 3 == 0)}" for k in range(n))


PASSAGE = prose("passage", 70)
ITEM = prose("item", 20)


def messy_rows():
    near = prose("near", 200)
    texts = {
        1: near, 2: near, 3: near.replace(near.split()[50], "changed", 1), 4: near + " and a tail", 5: None, 6: "", 7: " \n\t ", 8: "one two",
        9: "one two", 10: "ONE two", 11: PASSAGE + "\n" + prose(11, 30), 12: prose(12, 40) + " " + PASSAGE, 13: PASSAGE,
        14: prose(14, 60) + " " + ITEM + " " + prose(15, 9), 15: ITEM.upper(), 16: prose(16, 500) + " " + " ".join(ITEM.split()[:13]),
        17: "x " * 300, 18: "long " + prose(18, 45_000), 19: "ab" * 900, 20: "# $ %\nline one\nline one\n\nline one \n" + prose(20, 60),
        21: "Licensed under the Apache License, Version 2.0.", 22: prose(22, 80) + "\nReleased under the MIT License.\n" + prose(23, 20),
        23: "naïve café \U0001f600 日本語 тест " * 12, -4: prose("negative", 30), 24: prose(24, 5), 25: "\x00\x1c nul\x85 and \xa0 blanks",
    }
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 5 else None, None, *[f"{c}{i}" for c in EXTRA]) for i, t in texts.items()]
    rows.append(rows[0])  # a repeated row
    rows.append((None, near, "en", "src0", 1, *EXTRA))  # no document
    return rows


def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


def documents(rows):
    """(doc_id, text) of the rows that are documents, in order."""
    return sorted(((r[0], r[1] or "") for r in rows if r[0] is not None))


def removed_substrings(docs, length):
    data = [(i, t.encode()) for i, t in docs]
    starts = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = [False] * len(b)
        reach = 0
        for k in range(len(b)):
            if k + length <= len(b) and starts[b[k : k + length]] > 1:
                reach = k + length
            gone[k] = k < reach
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return sorted(out)


def removed_windows(docs, size):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out)


def shingles(text):
    w = words(text, low=True)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def similarity_classes(docs):
    """doc_id, set size, smallest doc_id reachable. Every pair that shares a shingle is compared."""
    sets = [(i, shingles(t)) for i, t in docs]
    holders, root = defaultdict(list), {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (_, own) in enumerate(sets):
        for x in own:
            holders[x].append(k)
    both = Counter((a, b) for ks in holders.values() for a in ks for b in ks if a < b)
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            low, high = sorted((find(sets[a][0]), find(sets[b][0])))
            root[high] = low
    return sorted((i, len(own), find(i)) for i, own in sets)


def contaminated(docs, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(item))
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                ids = windows.get(tuple(w[k : k + n]))
                if ids:
                    found |= ids
                    hit[k : k + n] = [True] * n
        h = sum(hit)
        out.append((i, len(w), h, len(found), sha(",".join(sorted(found))), h > 0 and 20 * h >= len(w)))
    return sorted(out)


def base_rules(text):
    w = words(text)
    triples = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {j for k in range(len(w) - 2) if triples[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    seen, equal = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            equal += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), equal, len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def shares(budget, children):
    """children: name -> (weight, cap). What each gets: full ones their cap, the others by weight, rounded down."""
    full = set()
    while True:
        rest = budget - sum(children[c][1] for c in full)
        weight = sum(w for c, (w, _) in children.items() if c not in full)
        more = {c for c, (w, cap) in children.items() if c not in full and weight and w and cap * weight <= rest * w}
        if not more:
            return {c: cap if c in full else rest * w // weight if weight else 0 for c, (w, cap) in children.items()}
        # those of the smallest cap over weight first, as they leave most to the others
        full.add(min(more, key=lambda c: (children[c][1] / children[c][0], c)))


def terms(text):
    return ALNUM.findall(lower(text))


def frequencies(templates, texts):
    """Number of texts, and in how many each term of the templates is."""
    vocabulary = {t for _, x in templates for t in terms(x)}
    return len(texts), Counter(t for x in texts for t in set(terms(x)) & vocabulary)


def best_template(text, templates, counted, similar):
    """Licence and cosine of the best line, by dictionaries."""
    n_texts, frequency = counted

    def weight(t):
        return math.log((1 + n_texts) / (1 + frequency[t])) + 1

    best = (0.0, None)
    for line in text.split("\n"):
        own = {t: n * weight(t) for t, n in Counter(terms(line)).items()}
        for name, template in sorted(templates):
            other = {t: n * weight(t) for t, n in Counter(terms(template)).items()}
            norm = math.sqrt(sum(x * x for x in own.values()) * sum(x * x for x in other.values()))
            cosine = sum(x * other.get(t, 0) for t, x in own.items()) / norm if norm else 0.0
            if cosine >= similar and (cosine > best[0] + 1e-9 or abs(cosine - best[0]) <= 1e-9 and name < best[1]):
                best = cosine, name
    return best


# -- packing, spelling, trie ---------------------------------------------------


def pieces(docs, tokenizer, size=4096):
    """doc_id, piece, start, length, crc32 of documents cut into pieces."""
    out = []
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), size)):
            part = ids[a : a + size]
            out.append((i, k, a, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return out


def spelling(docs):
    """word, form, root, n, n_near, form_n."""
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters, forms, near = sorted(set("".join(known))), {}, {}
    for w in known:
        places = range(len(w) + 1)
        edits = {w[:k] + w[k + 1 :] for k in places[:-1]} | {w[:k] + c + w[k:] for k in places for c in letters} | {w[:k] + c + w[k + 1 :] for k in places[:-1] for c in letters}
        own = [v for v in edits - {w} if v in known]
        near[w] = len(own)
        best = min(own, key=lambda v: (-known[v], v), default=None)
        forms[w] = best if best and known[best] >= 10 * known[w] else None
    out = []
    for w, n in known.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, near[w], known.get(forms[w])))
    return sorted(out)


def trie(turns):
    """conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends digest of rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            x = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, x), (role, text)))
    own = {c: [t for _, t in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + rows[h:])
    members = defaultdict(list)
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members[rows[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    saved, leaves = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += node not in children
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], leaves[node], saved[node],
         sha(",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))))
        for node, who in members.items()
    )
