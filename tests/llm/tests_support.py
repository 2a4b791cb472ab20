"""Brute force and names that several tests share."""

#: Names that the operators use for columns of their own.
CLASHING = (
    "key num n_words words class score line a b source removed lines n_lines n_removed held_out predicted kept bucket label links "
    "times n size hash print digest plain tie content pos term wid x y done"
).split()


def brute_lines_of(docs):
    """Texts without the lines that match an earlier one, by comparing all of them."""
    earlier, out = [], {}
    for row in sorted(docs.collect(), key=lambda r: r.doc_id):
        kept = []
        for line in row.text.split("\n"):
            words = set(line.split())
            if not words or not any(5 * len(words & w) >= 4 * len(words | w) for w in earlier if min(len(w), len(words)) * 5 >= 4 * max(len(w), len(words))):
                kept.append(line)
            earlier.append(words)
        out[row.doc_id] = "\n".join(kept)
    return out
