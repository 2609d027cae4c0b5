"""The choice among the passages of a document that an item is retrieved for."""

from readkin.llm import decontamination


class TwoPassages:
    """One passage holds most of question and answer; another holds more of the item, but no answer."""

    rules = decontamination.Rules()
    overlaps = {0: (0.75, 0.82, 0.82), 640: (0.78, 0.9, 0.0)}

    def retrieve(self, texts):
        return {(0, first, 3) for first in self.overlaps}

    def verify(self, words, first, item):
        return self.overlaps[first]


def test_every_passage_is_tested():
    assert list(decontamination._hits([b"a text"], TwoPassages())) == [(0, 3, 0.75, 0.82, 0.82)]
