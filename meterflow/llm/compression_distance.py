"""Two Zstandard dictionaries, and what a window saves by one of them.

A text is cut into windows of a few words. The ordinary dictionary knows ordinary text; the
toxic one knows the same and, besides, what toxic text has of its own. A window's gain is
the number of bytes that the second saves over the first: none for ordinary text, since
both find the same matches, some where toxic wording occurs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

#: Words of a window, and its most bytes; what is longer is cut.
WINDOW_WORDS, WINDOW_BYTES = 6, 512
#: Gains are told apart between these.
LEAST_GAIN, MOST_GAIN = -2, 9
#: Compressed together at most.
GROUP_BYTES = 1 << 22
#: Bytes of the two dictionaries.
ORDINARY_BYTES, TOXIC_BYTES = 112_640, 16_384


def windows(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, so many at a time; none for a text without words."""
    words = (text or "").lower().encode().split()
    cut = [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]
    if any(len(window) > WINDOW_BYTES for window in cut):
        cut = [window[i : i + WINDOW_BYTES] for window in cut for i in range(0, len(window), WINDOW_BYTES)]
    return cut


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Thorough search (all of the content is indexed), frames without anything but the block."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=19, hash_log=17, search_log=6, min_match=4, target_length=64,
        strategy=zstandard.STRATEGY_BTLAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary's bytes; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=50, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(ordinary: list[bytes], toxic: dict[bytes, int]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary, from ordinary windows and words of toxic text with their counts.

    Training favours long shared runs, so toxic words that it left out are put in as they are.
    """
    base = _trained(ORDINARY_BYTES, ordinary)
    by_count = sorted(toxic, key=lambda word: (toxic[word], word))
    samples = [b" " + word + b" " for word in by_count for _ in range(min(toxic[word], 100))]
    own = _trained(TOXIC_BYTES, samples) if samples else b""
    left_out = [b" " + word + b" " for word in by_count if b" " + word + b" " not in own]
    return base, (own + b"".join(left_out))[-2 * TOXIC_BYTES :] + base


class Gains:
    """Compresses windows with both dictionaries."""

    def __init__(self, contents: tuple[bytes, bytes]):
        self.ordinary, self.toxic = map(_compressor, contents)

    def of(self, cut: list[bytes]) -> np.ndarray:
        found = np.zeros(len(cut), np.int8)
        begin = 0
        while begin < len(cut):
            end, size = begin, 0
            while end < len(cut) and size < GROUP_BYTES:
                size += len(cut[end])
                end += 1
            group = cut[begin:end]
            lengths = [
                np.fromiter(map(len, compressor.multi_compress_to_buffer(group)), np.int64, len(group))
                for compressor in (self.ordinary, self.toxic)
            ]
            found[begin:end] = np.clip(lengths[0] - lengths[1], LEAST_GAIN, MOST_GAIN)
            begin = end
        return found


def heaviest_run(weights: np.ndarray) -> float:
    """The largest sum of adjoining weights, 0 if all are negative."""
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    return float((sums - np.minimum.accumulate(sums)).max())


@dataclass(frozen=True)
class Calibration:
    """A window's gain weighs as much as it speaks for toxic text; a document counts by its heaviest run of windows."""

    weights: np.ndarray
    slope: float
    intercept: float

    def run(self, gains: np.ndarray) -> float:
        return heaviest_run(self.weights[gains.astype(np.int64) - LEAST_GAIN])

    def score(self, gains: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.run(gains) + self.intercept, -50, 50))))


def calibrate(gains: list[np.ndarray], toxic: np.ndarray) -> Calibration:
    """From documents that the dictionaries were not trained on."""
    counts = np.full((2, MOST_GAIN - LEAST_GAIN + 1), 0.5)
    for found, mark in zip(gains, toxic):
        if len(found):
            # A document's windows together count once, so that long ones do not decide alone.
            counts[int(mark)] += np.bincount(found.astype(np.int64) - LEAST_GAIN, minlength=counts.shape[1]) / len(found) ** 0.5
    shares = counts / counts.sum(axis=1, keepdims=True)
    weights = np.log(shares[1] / shares[0])
    # More gain never speaks against toxic text.
    zero = -LEAST_GAIN
    weights[: zero + 1] = np.minimum(weights[zero], 0.0)
    weights[zero:] = np.maximum.accumulate(weights[zero:])
    empty = Calibration(weights, 0.0, 0.0)
    slope, intercept = _logistic(np.array([empty.run(found) for found in gains]), toxic.astype(float))
    return Calibration(weights, slope, intercept)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method. Classes weigh as the roots of their sizes, so that neither is given up."""
    weight = np.where(y == 1, max(1, (y == 1).sum()) ** -0.5, max(1, (y == 0).sum()) ** -0.5)
    weight /= weight.sum()
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])
