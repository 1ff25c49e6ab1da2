"""Plain versions that tests hold results against."""


def groups_of(nodes, links):
    """node -> smallest node reachable, by union-find."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a) if a in up else None, top(b) if b in up else None
        if a is not None and b is not None and a != b:
            up[max(a, b)] = min(a, b)
    return {n: top(n) for n in up}


def first_fit(sizes, context):
    """First-fit decreasing by looking at every bin."""
    bins, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b, used in enumerate(bins):
            if used + sizes[i] <= context:
                out[i] = (b, used)
                bins[b] += sizes[i]
                break
        else:
            out[i] = (len(bins), 0)
            bins.append(sizes[i])
    return out


def split_words(text, separators):
    out, word = [], ""
    for c in text + separators[0]:
        if c in separators:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
