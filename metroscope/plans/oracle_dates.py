"""Date-typed result columns per oracle query (generated from DESCRIBE; both engines
return them as midnight timestamps so any value hash sees the same type)."""

DATE_COLUMNS = {
    'a10_mean_close': ('d',),
    'a11_top_category': ('d',),
    'a12_pivot_daily_values': ('obs_date',),
    'a13_alert_score': ('d',),
    'a2_daily': ('window_start',),
    'a5_weather_daily': ('obs_date',),
    'a6_news_daily': ('obs_date',),
    'a7_news_daily_distinct': ('obs_date',),
    'a9_open_backlog': ('d',),
    'd10_legacy_profile': ('score_date',),
    'd5_today_view': ('d',),
    'd7_five_signals': ('d',),
    'd8_score_window': ('score_date',),
    'd9_column_drift': ('obs_date',),
    'd9_quality_report': ('last_day',),
    'e10_latest_composite': ('score_date',),
    'e10_latest_verdict': ('verdict_date',),
    'e12_news_job': ('obs_date',),
    'e12_news_tsv': ('obs_date',),
    'e13_weather': ('obs_date',),
    'e14_alerts': ('obs_date',),
    'e17_window': ('metric_date',),
    'e7_signal_scores': ('score_date',),
    'f1_validate_counts': ('obs_date',),
    'f2_city_filter': ('obs_date',),
    'f7_latest_metrics': ('metric_date',),
    'f8_stored': ('metric_date',),
    'j4_source_fallback': ('obs_date',),
    'm2_partial_upsert': ('obs_date',),
    'm3_insert_absent': ('obs_date',),
    'p4_alerts': ('obs_date',),
    'p5_json_props': ('obs_date',),
    's11_landing_json': ('date',),
    't4_composite_delta': ('score_date',),
    'u2_metric_cards': ('metric_date',),
    'w10_card_baseline': ('metric_date',),
    'w11_heat_streak': ('d',),
    'w12_precip_72h': ('d',),
    'w6_tone_7d': ('obs_date',),
    'w7_anomaly_score': ('d',),
    'w8_heat_score': ('obs_date',),
    'w9_composite_baseline': ('score_date',),
    'x10_primary_driver': ('score_date',),
    'x11_verdict': ('verdict_date',),
    'x12_delta_label': ('metric_date',),
    'x13_display_value': ('metric_date',),
}
