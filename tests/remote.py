"""A remote collection of 25 records, for the tests of paged reading."""


def demo_page(slice_name: str, offset: int, length: int) -> list[dict]:
    return [{"id": k, "slice": slice_name} for k in range(offset, min(offset + length, 25))]


def moody_page(slice_name: str, offset: int, length: int) -> list[dict]:
    """The same records, from a remote side that refuses about every third request."""
    import random

    from loomwright.sources.paged import Busy

    if random.random() < 0.34:
        raise Busy
    return demo_page(slice_name, offset, length)
