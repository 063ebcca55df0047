"""The rule of line dedup, written plainly: every stretch as text, no keys."""

import xxhash


def words(text):
    return len(text.encode("utf-8").split())


def boundaries(lines):
    """Line numbers at which a chunk begins: 0, and each line whose hash, with
    that of the line before, mixes to an even number."""
    h = [xxhash.xxh3_64(x.encode("utf-8")).intdigest() for x in lines]
    out = [0]
    for i in range(1, len(lines)):
        x = (h[i - 1] * 0x9E3779B97F4A7C15 + h[i]) % 2**64
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD % 2**64
        if (x ^ (x >> 33)) % 2 == 0:
            out.append(i)
    return out + [len(lines)]


def counted(lines):
    edges = boundaries(lines)
    return [(a, z) for a, z in zip(edges, edges[1:]) if sum(words(x) > 0 for x in lines[a:z]) >= 2]


def seeds(lines):
    """Chunks that count, and shortest runs of 50 words without one strictly inside."""
    chunks = counted(lines)
    size = [words(x) for x in lines]
    out = set(chunks)
    for a in range(len(lines)):
        for z in range(a + 1, len(lines) + 1):
            n = sum(size[a:z])
            if (n >= 50 and (n - size[z - 1] < 50 or n - size[a] < 50)
                    and not any(a < b and e < z for b, e in chunks)):
                out.add((a, z))
            if n - size[a] >= 50:
                break
    return out


def growths(lines, chunk):
    chunks = counted(lines)
    if chunk not in chunks:
        return
    k = chunks.index(chunk)
    a, z = chunk
    for x in range(chunks[k - 1][0] if k else 0, a):
        yield x, z
    for x in range(z + 1, (chunks[k + 1][1] if k + 1 < len(chunks) else len(lines)) + 1):
        yield a, x


def dedup(rows):
    """(doc_id, text) of rows -> the same without the stretches that stand at an earlier place."""
    texts = {}
    for d, t in rows:
        if t:
            # the order of texts that share an id
            texts[(d is None, d or 0, xxhash.xxh3_64(t.encode("utf-8")).intdigest() - 2**63)] = t.split("\n")
    first, many = {}, {}
    own = {}
    for at, lines in texts.items():
        own[at] = {s: "\n".join(lines[s[0]:s[1]]) for s in seeds(lines)}
        for (a, _), p in own[at].items():
            many.setdefault(p, set()).add((*at, a))
    for at, lines in texts.items():
        for s in list(own[at]):
            if len(many["\n".join(lines[s[0]:s[1]])]) > 1:
                for a, z in growths(lines, s):
                    own[at][(a, z)] = "\n".join(lines[a:z])
    for at, mine in own.items():
        for (a, _), p in mine.items():
            first[p] = min(first.get(p, (*at, a)), (*at, a))
    out = []
    for d, t in rows:
        if not t:
            out.append((d, t))
            continue
        at = (d is None, d or 0, xxhash.xxh3_64(t.encode("utf-8")).intdigest() - 2**63)
        gone = set()
        for (a, z), p in own[at].items():
            if first[p] != (*at, a):
                gone.update(range(max(a, first[p][3] + z - a) if first[p][:3] == at else a, z))
        out.append((d, "\n".join(x for i, x in enumerate(texts[at]) if i not in gone)))
    return sorted(out, key=str)
