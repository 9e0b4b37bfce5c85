"""The rules once more, as plain loops."""


def fold(rows, ttl, anchor=None):
    """rows: sorted times of one key -> [(time, is_duplicate, anchor)]"""
    out = []
    for t in rows:
        if anchor is not None and t - anchor <= ttl:
            out.append((t, True, anchor))
        else:
            anchor = t
            out.append((t, False, anchor))
    return out


def fold_rows(rows, ttl, known=None):
    """rows: (key, ts, ordinal, seq), any order -> {(key, ts, ordinal, seq): (is_duplicate, anchor)}"""
    anchors, out = dict(known or {}), {}
    for row in sorted(rows, key=lambda r: r[1:]):
        key, ts = row[0], row[1]
        if key is None:
            out[row] = (False, None)
            continue
        anchor = anchors.get(key)
        repeat = anchor is not None and ts - anchor <= ttl
        if not repeat:
            anchors[key] = ts
        out[row] = (repeat, anchors[key])
    return out
