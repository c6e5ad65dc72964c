"""Small tables with odd rows, and plain versions of the rules that operators are held against."""

import hashlib
import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, shard int, hash string"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randint(0, words)}x" for _ in range(n))


def odd_texts(seed=1):
    rng = random.Random(seed)
    base = sentence(rng, 120)
    other = sentence(rng, 90)
    shared = sentence(rng, 40)
    near = base.split()
    near[60] = "changed"
    return [
        None, "", "   \n\t ", "one", "One two", "a b c d", "A B C D", "a b c d e", base, base.upper(), " ".join(near), base.replace(" ", "\n"),
        other + " " + shared, shared + " " + sentence(rng, 50), sentence(rng, 30) + "\x0b" + shared + "\r" + other,
        "no break space 　 wide  two", "日本語のテキスト 日本語のテキスト 😀", "é" * 300, " ".join(["same"] * 200),
        sentence(rng, 6000, 10**6), "x" * 70_000, base, base, "<|endoftext|> ok", "tab\tseparated\x0cform",
    ]


def odd_docs(spark, seed=1, texts=None):
    """Odd texts with gaps in every column, a repeated row and a row without id."""
    texts = odd_texts(seed) if texts is None else texts
    rows = [(3 * i + 1, t, None if i % 3 else "en", None if i % 4 else "src", i, 0.9, "r", 5, "h") for i, t in enumerate(texts)]
    rows.append(rows[8])
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(5)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SPACE = r"[^\x20\x09-\x0D]+"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_exact(rows):
    """``doc_id, text`` to ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        same = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        _, none, keep = min(groups[same])
        keep = None if none else keep
        out.append((i, keep, len(groups[same]), i == keep, sha(same)))
    return out


def plain_near(rows, percent=85, size=5):
    """``doc_id, text`` with different ids to ``doc_id: (n_shingles, component)``."""
    sets = {}
    for i, t in rows:
        words = re.findall(SPACE, fold(t))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def plain_repeats(rows, window=13):
    """``doc_id, text`` to sorted ``doc_id, n_words, n_removed, sha`` rows."""
    words = [re.findall(SPACE, t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_leaks(rows, items, window=10):
    """``doc_id, text`` and ``item_id, text`` to ``doc_id, n_words, n_hit, n_items, sha, contaminated`` rows."""
    runs = {}
    for name, t in items:
        w = re.findall(WORD, fold(t))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            runs.setdefault(tuple(w[k : k + size]), set()).add("" if name is None else str(name))
    sizes = {len(r) for r in runs}
    out = []
    for i, t in rows:
        w = re.findall(WORD, fold(t))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                names = runs.get(tuple(w[k : k + size]))
                if names:
                    hit.update(range(k, k + size))
                    found |= names
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out
