"""Declared schemas (A5) of the tables that a day run writes: columns in order,
with the types of the fixture mapping (ids are BIGINT there, money and lengths
DOUBLE; call detail and matches carry the reference's string ids).

``_TYPES`` names the type of a column wherever it appears; a table that differs
says so with ``column:type``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": """
        both_call_times both_play_times both_request_times both_success_times channel_id frequency
        frequency_rnk frequency_rnk_max frequency_score friend_call_times friend_call_users
        friend_video_times friend_video_users hotvideo_call_times hotvideo_combination_score
        hotvideo_play_times hotvideo_request_times hotvideo_rnk hotvideo_success_times level
        monetary1_rnk monetary1_score monetary2_rnk monetary_rnk monetary_rnk_max monetary_score
        recency recency_call_interval recency_rnk recency_rnk_max recency_score rfm_rnk
        streamer_amount_total streamer_country_id streamer_id user_cnt user_country_id user_id
        user_region_id""",
    "double": """
        avg_video_duration call_gold_coin_amount call_total_length final_score1 final_score2
        final_score3 gift_gold_coin_amount gold_coin_amount hotvideo_rank_score_norm
        hotvideo_raw_score_norm hotvideo_score monetary monetary1 monetary2 percentage
        percentage_rule preference preference_rule raw_hotvideo_score raw_score
        rfm_combination_score rfm_rnk_percentage rfm_score streamer_active_amount streamer_amount
        success_rate_both success_rate_hotvideo total_video_duration user_active_amount""",
    "string": """
        channel_name day if_vip is_user_vip region_name streamer_country_name
        streamer_country_name_ab streamer_region_name user_country_name user_country_name_ab
        user_region_name""",
    "timestamp_ntz": """
        call_begin_time call_end_time""",
}

_TABLES = {
    "call_record_detail_match": """
        day user_id:string user_country_id:string user_country_name is_user_vip streamer_id:string
        streamer_country_id:string streamer_country_name channel_id channel_name call_begin_time
        call_end_time call_total_length call_gold_coin_amount gift_gold_coin_amount""",
    "country_activity_detail": """
        user_country_name user_country_name_ab user_region_name if_vip streamer_country_name
        streamer_country_name_ab streamer_region_name user_cnt both_play_times both_call_times
        both_request_times both_success_times hotvideo_play_times hotvideo_call_times
        hotvideo_request_times hotvideo_success_times friend_call_users friend_call_times
        friend_video_users friend_video_times total_video_duration avg_video_duration
        success_rate_both success_rate_hotvideo raw_score""",
    "country_band_calls": """
        user_id user_country_id user_country_name user_region_name is_user_vip streamer_id
        streamer_country_id streamer_country_name frequency call_total_length gold_coin_amount
        recency_call_interval""",
    "country_behaviour_score": """
        user_country_name user_country_name_ab user_region_name if_vip streamer_country_name
        streamer_country_name_ab streamer_region_name user_cnt both_play_times both_call_times
        both_request_times both_success_times hotvideo_play_times hotvideo_call_times
        hotvideo_request_times hotvideo_success_times friend_call_users friend_call_times
        friend_video_users friend_video_times total_video_duration avg_video_duration
        success_rate_both success_rate_hotvideo raw_score hotvideo_rnk hotvideo_combination_score
        hotvideo_rank_score_norm hotvideo_raw_score_norm hotvideo_score""",
    "country_pair_score": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        frequency monetary monetary1 recency frequency_rnk monetary_rnk monetary1_rnk recency_rnk
        frequency_score monetary_score monetary1_score recency_score rfm_combination_score rfm_score
        rfm_rnk""",
    "country_preference": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        rfm_rnk preference""",
    "country_preference_all": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        preference""",
    "country_preference_all_blend": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        preference preference_rule""",
    "country_preference_detail": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        frequency monetary monetary1 recency frequency_rnk monetary_rnk monetary1_rnk recency_rnk
        frequency_score monetary_score monetary1_score recency_score rfm_combination_score rfm_score
        rfm_rnk rfm_rnk_percentage preference""",
    "country_preference_distribution": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        preference percentage""",
    "country_preference_distribution_blend": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        preference percentage preference_rule percentage_rule""",
    "country_recall_by_level": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        level percentage""",
    "country_recall_filtering": """
        user_country_name streamer_country_name user_country_id is_user_vip streamer_country_id
        preference""",
    "country_recall_filtering_rule": """
        user_country_name streamer_country_name user_country_id is_user_vip streamer_country_id
        preference_rule""",
    "country_recall_percentage": """
        user_country_name streamer_country_name user_country_id is_user_vip streamer_country_id
        preference percentage""",
    "country_recall_percentage_rule": """
        user_country_name streamer_country_name user_country_id is_user_vip streamer_country_id
        preference percentage""",
    "country_recall_share": """
        user_country_id user_country_name is_user_vip streamer_country_id streamer_country_name
        percentage""",
    "country_score_integration": """
        user_country_id user_country_name user_country_name_ab user_region_name if_vip
        streamer_country_id streamer_country_name streamer_country_name_ab streamer_region_name
        final_score1 final_score2 final_score3 rfm_score hotvideo_score raw_hotvideo_score
        success_rate_hotvideo""",
    "country_score_integration_detail": """
        user_country_id user_country_name user_country_name_ab streamer_country_id
        streamer_country_name if_vip rfm_score user_region_name streamer_country_name_ab
        streamer_region_name hotvideo_score raw_hotvideo_score success_rate_hotvideo
        success_rate_both user_cnt both_play_times both_call_times both_request_times
        both_success_times hotvideo_play_times hotvideo_call_times hotvideo_request_times
        hotvideo_success_times friend_call_users friend_call_times friend_video_users
        friend_video_times total_video_duration avg_video_duration final_score1 final_score2
        final_score3""",
    "country_score_integration_filtering": """
        user_country_id user_country_name user_country_name_ab user_region_name if_vip
        streamer_country_id streamer_country_name streamer_country_name_ab streamer_region_name
        final_score1 final_score2 final_score3 rfm_score hotvideo_score raw_hotvideo_score user_cnt
        both_play_times both_call_times both_request_times both_success_times hotvideo_play_times
        hotvideo_call_times hotvideo_request_times hotvideo_success_times friend_call_users
        friend_call_times friend_video_users friend_video_times total_video_duration
        avg_video_duration success_rate_both success_rate_hotvideo""",
    "country_streamer_amount": """
        streamer_country_id streamer_country_name streamer_country_name_ab streamer_region_name
        streamer_active_amount""",
    "country_user_amount": """
        user_country_id user_country_name user_active_amount""",
    "country_user_amount_vip": """
        user_country_id user_country_name is_user_vip user_active_amount""",
    "country_user_level": """
        user_id user_country_id user_country_name is_user_vip level""",
    "country_user_level_detail": """
        user_id user_country_id user_country_name is_user_vip frequency monetary recency
        frequency_rnk monetary_rnk recency_rnk frequency_score monetary_score recency_score
        rfm_score rfm_rnk rfm_rnk_percentage level""",
    "region_activity_detail": """
        user_region_name if_vip streamer_country_name streamer_country_name_ab streamer_region_name
        user_cnt both_play_times both_call_times both_request_times both_success_times
        hotvideo_play_times hotvideo_call_times hotvideo_request_times hotvideo_success_times
        friend_call_users friend_call_times friend_video_users friend_video_times
        total_video_duration avg_video_duration success_rate_both success_rate_hotvideo raw_score""",
    "region_band_calls": """
        user_id user_country_id user_country_name user_region_name is_user_vip streamer_id
        streamer_country_id streamer_country_name frequency call_total_length gold_coin_amount
        recency_call_interval""",
    "region_behaviour_score": """
        user_region_name if_vip streamer_country_name streamer_country_name_ab streamer_region_name
        user_cnt both_play_times both_call_times both_request_times both_success_times
        hotvideo_play_times hotvideo_call_times hotvideo_request_times hotvideo_success_times
        friend_call_users friend_call_times friend_video_users friend_video_times
        total_video_duration avg_video_duration success_rate_both success_rate_hotvideo raw_score
        hotvideo_rnk hotvideo_combination_score hotvideo_rank_score_norm hotvideo_score""",
    "region_country_user_level": """
        user_id user_country_id user_country_name user_region_name is_user_vip rfm_rnk_percentage
        level""",
    "region_country_user_level_detail": """
        user_id user_country_id user_country_name user_region_name is_user_vip frequency monetary1
        monetary2 recency rfm_score rfm_rnk rfm_rnk_percentage level""",
    "region_pair_score": """
        user_region_name is_user_vip streamer_country_id streamer_country_name frequency monetary
        monetary1 recency frequency_rnk monetary_rnk monetary1_rnk recency_rnk frequency_score
        monetary_score monetary1_score recency_score rfm_combination_score rfm_score rfm_rnk""",
    "region_preference": """
        user_region_name is_user_vip streamer_country_id streamer_country_name rfm_rnk preference""",
    "region_preference_all": """
        user_region_name is_user_vip streamer_country_id streamer_country_name preference""",
    "region_preference_all_blend": """
        user_region_name is_user_vip user_region_id streamer_country_id streamer_country_name
        preference""",
    "region_preference_detail": """
        user_region_name is_user_vip streamer_country_id streamer_country_name frequency monetary
        monetary1 recency frequency_rnk monetary_rnk monetary1_rnk recency_rnk frequency_score
        monetary_score monetary1_score recency_score rfm_combination_score rfm_score rfm_rnk
        rfm_rnk_percentage preference""",
    "region_preference_distribution": """
        user_region_name is_user_vip streamer_country_id streamer_country_name preference percentage""",
    "region_preference_distribution_blend": """
        user_region_id user_region_name is_user_vip streamer_country_id streamer_country_name
        preference percentage""",
    "region_recall_filtering": """
        user_region_name streamer_country_name user_region_id is_user_vip streamer_country_id
        preference""",
    "region_recall_percentage": """
        user_region_name streamer_country_name user_region_id is_user_vip streamer_country_id
        preference percentage""",
    "region_score_integration": """
        user_region_name if_vip streamer_country_id streamer_country_name streamer_country_name_ab
        streamer_region_name final_score1 final_score2 final_score3 rfm_score hotvideo_score
        raw_hotvideo_score success_rate_hotvideo""",
    "region_score_integration_detail": """
        user_region_name streamer_country_id streamer_country_name if_vip rfm_score
        streamer_country_name_ab streamer_region_name hotvideo_score raw_hotvideo_score
        success_rate_hotvideo success_rate_both user_cnt both_play_times both_call_times
        both_request_times both_success_times hotvideo_play_times hotvideo_call_times
        hotvideo_request_times hotvideo_success_times friend_call_users friend_call_times
        friend_video_users friend_video_times total_video_duration avg_video_duration final_score1
        final_score2 final_score3""",
    "region_score_integration_filtering": """
        user_region_name if_vip streamer_country_id streamer_country_name streamer_country_name_ab
        streamer_region_name final_score1 final_score2 final_score3 rfm_score hotvideo_score
        raw_hotvideo_score success_rate_hotvideo""",
    "region_streamer_amount": """
        region_name streamer_amount""",
    "region_user_level": """
        user_id user_region_name is_user_vip rfm_rnk_percentage level""",
    "region_user_level_detail": """
        user_id user_region_name is_user_vip frequency monetary1 monetary2 recency rfm_score rfm_rnk
        rfm_rnk_percentage level""",
    "streamer_call_base": """
        user_id user_country_id user_country_name user_region_name is_user_vip streamer_id
        streamer_country_id streamer_country_name_ab streamer_country_name streamer_region_name
        frequency call_total_length gold_coin_amount recency_call_interval""",
    "streamer_level": """
        streamer_id streamer_country_id streamer_country_name level rfm_score""",
    "streamer_level_detail": """
        streamer_id streamer_country_id streamer_country_name frequency monetary monetary1 recency
        frequency_rnk monetary_rnk monetary1_rnk recency_rnk frequency_score monetary_score
        monetary1_score recency_score rfm_combination_score rfm_score rfm_rnk rfm_rnk_percentage
        level""",
    "streamer_level_distribution": """
        streamer_country_id streamer_country_name level streamer_amount:bigint streamer_amount_total
        percentage""",
    "streamer_rfm_score": """
        streamer_id streamer_country_id streamer_country_name frequency monetary monetary1 recency
        frequency_rnk monetary_rnk monetary1_rnk recency_rnk frequency_score monetary_score
        monetary1_score recency_score rfm_combination_score rfm_score""",
    "user_call_base": """
        user_id user_country_id user_country_name is_user_vip streamer_id streamer_country_id
        streamer_country_name frequency call_total_length gold_coin_amount recency_call_interval""",
    "user_quintile_score": """
        user_id user_country_id user_country_name is_user_vip frequency monetary recency
        frequency_rnk monetary_rnk recency_rnk frequency_rnk_max frequency_score monetary_rnk_max
        monetary_score recency_rnk_max recency_score rfm_score""",
    "user_rfm_total_score": """
        user_id user_country_id user_country_name user_region_name is_user_vip frequency monetary1
        monetary2 recency frequency_rnk monetary1_rnk monetary2_rnk recency_rnk
        rfm_combination_score rfm_score""",
}

_SPARK = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "timestamp_ntz": T.TimestampNTZType()}
_TYPE_OF = {c: t for t, columns in _TYPES.items() for c in columns.split()}


def _schema(columns: str) -> T.StructType:
    fields = []
    for c in columns.split():
        name, _, kind = c.partition(":")
        fields.append(T.StructField(name, _SPARK[kind or _TYPE_OF[name]]))
    return T.StructType(fields)


DAY_SCHEMAS: dict[str, T.StructType] = {n: _schema(c) for n, c in _TABLES.items()}
