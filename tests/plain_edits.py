"""The edit similarities of one pair of strings, step by step; the engine's batches are held against them."""


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel addition over one machine-independent integer."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 * 2 * common_length(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    p, q = (" ".join(sorted(z)) for z in (x - y, y - x))
    if both and (not p or not q):
        return 100.0
    p, q = f"{both} {p}".strip(), f"{both} {q}".strip()
    return max(ratio(p, q), *((ratio(both, p), ratio(both, q)) if both else (0.0,)))


def _best_window(a: str, b: str) -> float:
    """Best ratio of ``a`` with any stretch of its length, or shorter at the ends, of ``b``, which is no shorter."""
    m, best = len(a), 0.0
    for i in range(1 - m, len(b)):
        window = b[max(0, i) : i + m]
        if 200.0 * min(m, len(window)) / (m + len(window)) > best:
            best = max(best, ratio(a, window))
            if best == 100.0:
                break
    return best


def partial_ratio(a: str, b: str) -> float:
    """The shorter string against windows of the longer; of equally long ones the better way round."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0
    best = _best_window(a, b)
    return max(best, _best_window(b, a)) if len(a) == len(b) and best < 100.0 else best
