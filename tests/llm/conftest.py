import hashlib
import math

import pytest

SF = "/root/testdata/sf0.001"


def digest_rows(cols, rows):
    """An order-insensitive list of the rows' values, columns by name."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return ("nan" if math.isnan(v) else repr(v)) if isinstance(v, float) else repr(v)

    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture
def same_rows():
    return digest_rows


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()
