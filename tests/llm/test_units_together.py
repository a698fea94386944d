"""Units of the token store go through the library together, each distinct one once."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from readsift.llm import dac


class Counted:
    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **more):
        self.texts += texts
        return self.library.encode_batch_fast(texts, **more)


def test_units_go_through_the_library_together():
    library = Tokenizer.from_file(public_tokenizers.path(dac.VOCABULARY))
    own = dac.Encoder(dac.VOCABULARY)
    own.library = Counted(library)
    texts = [" ".join(f"w{i * j}é,\n{j}" for j in range(50)) for i in range(40)] + ["a  b w0é,\n0", "x <|endoftext|>y z", ""]
    for given in (texts, pa.array(texts)[1:]):
        ids, sizes = own.encode(given)
        for text, got in zip(texts[-len(given) :], np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert got.tolist() == [*library.encode(text, add_special_tokens=False).ids, dac.END]
    first = {text.split(" ")[0] for text in texts}
    assert len(own.library.texts) <= len(first) + 3  # the beginnings, one unit with a special string, all others at once
    assert len(own.units.slot) > 1000
