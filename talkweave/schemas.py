"""Record schemas. Files are always read with one of these, never with inferred types."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _row(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in columns.items()])


def _list(of: T.DataType) -> T.ArrayType:
    return T.ArrayType(of)


SCRIPT = _row(conversation_id=S, category=S, topic=S, turns=_list(_row(speaker=S, text=S)), estimated_duration_sec=D)
AUDIO_TURN = _row(speaker=I, text=S, audio_path=S, start_ms=L, end_ms=L)
OVERLAP = _row(turn_a=I, turn_b=I, overlap_start_ms=L, overlap_end_ms=L, type=S)
CONVERSATION = _row(conversation_id=S, category=S, language=S, duration_sec=D, script_path=S, mixed_audio_path=S, turns=_list(AUDIO_TURN), overlaps=_list(OVERLAP))
TOKENS = _row(conversation_id=S, source_json=S, codebook_count=I, training_codebooks=I, codes_full=_list(_list(I)), codes_training=_list(_list(I)))
SEQUENCE = _row(conversation_id=S, source_json=S, tokens=_list(S), loss_mask=_list(I))
BUCKET = _row(name=S, count=I, turn_min=I, turn_max=I, duration_min_sec=D, duration_max_sec=D, duration_avg_sec=D, words_min=I, words_max=I, description=S)
CODEC_ROW = _row(id=S, text=S, speaker_id=S, codes=_list(_list(T.ShortType())), n_frames=I, k_codebooks=I, sampling_rate=I, duration_sec=T.FloatType(), source_dataset=S, source_split=S)
PROMPT = _row(s1_prompt_transcription=S, s2_prompt_transcription=S, s1_prompt_wav=S, s2_prompt_wav=S)
REPORT = _row(ok=B, checked=L, errors=_list(S))
