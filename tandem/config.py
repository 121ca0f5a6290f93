"""Typed configuration objects.

Fixed values below must equal the reference's settings for identical
results; they are stated once here and passed as parameters everywhere else.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# --- fixed values (must equal the reference) --------------------------------
# Cleaning thresholds: sentence length in words (inclusive both ends),
# maximum length ratio (inclusive), quality score threshold (strict, float32).
MIN_LEN = 3
MAX_LEN = 150
MAX_RATIO = 2.0
SCORE_THRESHOLD = 1.0872

# Special tokens and their ids, in this order.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[SOS]", "[EOS]"]
PAD_ID = 0
UNK_ID = 1
SOS_ID = 2
EOS_ID = 3

# Vocabulary size, maximum sequence length, batch sizes.
VOCAB_SIZE = 32_000
MAX_SEQ_LEN = 150
TRAIN_BATCH_SIZE = 32
EVAL_BATCH_SIZE = 64
NUM_SAMPLES_TO_USE = 1000

# Training schedule and early stopping.
LEARNING_RATE = 5e-4
EPOCHS = 5
WARMUP_FRACTION = 0.1
LABEL_SMOOTHING = 0.1
PATIENCE = 5
MIN_DELTA = 1e-4
SEED = 42
LOG_EVERY = 100
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanConfig:
    min_len: int = MIN_LEN
    max_len: int = MAX_LEN
    max_ratio: float = MAX_RATIO
    score_threshold: float = SCORE_THRESHOLD


@dataclass(frozen=True)
class TokenizerConfig:
    vocab_size: int = VOCAB_SIZE
    special_tokens: tuple = tuple(SPECIAL_TOKENS)
    pad_id: int = PAD_ID
    unk_id: int = UNK_ID
    sos_id: int = SOS_ID
    eos_id: int = EOS_ID


@dataclass(frozen=True)
class DataConfig:
    max_seq_len: int = MAX_SEQ_LEN
    train_batch_size: int = TRAIN_BATCH_SIZE
    eval_batch_size: int = EVAL_BATCH_SIZE
    num_samples: int = NUM_SAMPLES_TO_USE
    src_lang: str = "en"
    tgt_lang: str = "vi"
    seed: int = SEED


@dataclass(frozen=True)
class TrainConfig:
    learning_rate: float = LEARNING_RATE
    epochs: int = EPOCHS
    warmup_fraction: float = WARMUP_FRACTION
    label_smoothing: float = LABEL_SMOOTHING
    patience: int = PATIENCE
    min_delta: float = MIN_DELTA
    log_every: int = LOG_EVERY
    extra: dict = field(default_factory=dict)


def config_items(*configs) -> list[tuple[str, str]]:
    """Flatten config objects into (KEY, value) string pairs."""
    out: list[tuple[str, str]] = []
    for cfg in configs:
        for k, v in asdict(cfg).items():
            out.append((k.upper(), str(v)))
    return out
