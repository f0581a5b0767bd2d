"""Declared schemas; nothing is inferred."""

from __future__ import annotations

POSTS = "id long, created_at string, tag_string string, fav_count int, score int, is_deleted int"
TAGS = "id int, name string, category int, post_count long, is_deprecated int"
ALIASES = "antecedent_name string, consequent_name string, status string"
WIKI = "title string, other_names string, is_deleted int"
DIM_TAG = "tag_id int, name string, category byte, post_count long, is_deprecated boolean"
DAILY = "tag_id int, day date, posts long, fav_sum long, score_sum long"
TOTAL_DAILY = "day date, posts long, fav_sum long, score_sum long"
MONTHLY = "tag_id int, month date, posts long, fav_sum long, score_sum long"
TOTAL_MONTHLY = "month date, posts long, fav_sum long, score_sum long"
CATEGORY_MONTHLY = "category byte, month date, posts long, n_eff double, active_tags long"
PROPOSALS = "struct<fixes:map<string,string>,uncertain:map<string,string>,patterns:array<string>,reject:array<string>>"
BATCH_INPUT = "map<string,struct<category:string,posts:long,en:string,ja:string,aliases:array<string>,current_zh:string>>"

#: Category codes and display languages in slot order.
GENERAL, ARTIST, COPYRIGHT, CHARACTER, META = 0, 1, 3, 4, 5
LANGS = ("zh_hans", "zh_hant", "ja", "en", "ko")
