"""A Python worker keeps its tokenizer and the words it has counted from one task to the next."""

import pyarrow as pa
import public_tokenizers

from duebook.llm import tokencount

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokencount.load_tokenizer(PATH)


class Spy:
    """The library's tokenizer, noting what it is given."""

    def __init__(self):
        self.library, self.given = LIBRARY, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.library.encode_batch_fast(texts, **options)

    def lengths(self, texts):
        return [len(self.library.encode(t, add_special_tokens=False).ids) for t in texts]


def task(texts, version):
    columns = [pa.array([b"d"] * len(texts)), pa.array(texts), pa.array([len(t) for t in texts], pa.int64())]
    batch = pa.RecordBatch.from_arrays(columns, ["digest", "text", "n_chars"])
    found = list(tokencount._encode(PATH, version)(iter([batch])))
    return [n for b in found for n in b.column("n_tokens").to_pylist()]


def test_words_are_encoded_once_in_a_worker(monkeypatch):
    spies = []
    monkeypatch.setattr(tokencount, "load_tokenizer", lambda path: spies.append(Spy()) or spies[-1])
    tokencount.worker_state.cache_clear()
    first, second = ["the cat's hat", "", "the Zvonimir"], ["the cat's Zvonimir 2024", "hat <|endoftext|>"]
    plain = Spy()
    assert task(first, "one") == plain.lengths(first)
    assert task(second, "one") == plain.lengths(second)
    assert len(spies) == 1 and len(spies[0].given) == len(set(spies[0].given)) == 6
    # Another vocabulary in the same place starts anew.
    assert task(first, "two") == plain.lengths(first)
    assert len(spies) == 2
    tokencount.worker_state.cache_clear()


def test_memory_is_bounded_and_counts_stay_right(monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED_WORDS", 50)
    spy, known = Spy(), {"": 0}
    for at in range(10):
        texts = [f"word{at} the  w{at}x{i} " + "long" * 40 for i in range(20)] + [""]
        assert tokencount.count_texts(texts, spy, known) == spy.lengths(texts)
        assert len(known) <= 50 and max(map(len, known)) <= tokencount.REMEMBERED_CHARS and known[""] == 0
