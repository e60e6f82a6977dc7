"""Columns and types of the warehouse's tables. Names, types and order are as declared."""

TEXT, WHOLE, COUNT, MOMENT, DAY = "string", "int", "bigint", "timestamp_ntz", "date"
LIST, MOMENTS = "array<string>", "array<timestamp_ntz>"

AREAS = {
    "country_id": TEXT,
    "area_id": TEXT,
    "country_name": TEXT,
    "country_code": TEXT,
    "continent_id": TEXT,
    "continent_name": TEXT,
    "parent_area_id": TEXT,
}
COMPETITIONS = {
    "competition_id": TEXT,
    "competition_name": TEXT,
    "competition_code": TEXT,
    "competition_type": TEXT,
    "country_name": TEXT,
    "current_season_id": TEXT,
}
MATCHES = {
    "match_id": TEXT,
    "match_at": MOMENT,
    "status": TEXT,
    "matchday_number": WHOLE,
    "stage": TEXT,
    "home_team_id": TEXT,
    "away_team_id": TEXT,
    "referees_ids": LIST,
    "winner": TEXT,
    "duration_type": TEXT,
    "full_time_home_score": WHOLE,
    "full_time_away_score": WHOLE,
    "half_time_home_score": WHOLE,
    "half_time_away_score": WHOLE,
    "area_id": TEXT,
    "competition_id": TEXT,
    "season_id": TEXT,
    "last_updated_at": MOMENT,
}
TEAMS = {
    "team_id": TEXT,
    "team_name": TEXT,
    "team_short_name": TEXT,
    "team_code": TEXT,
    "country_name": TEXT,
    "team_address": TEXT,
    "website_url": TEXT,
    "logo_url": TEXT,
    "foundation_year_date": DAY,
    "team_colors": LIST,
    "arena_name": TEXT,
    "main_competition_id": TEXT,
    "running_competitions_ids": LIST,
    "player_ids": LIST,
    "coach_id": TEXT,
    "coach_contract_start_date": DAY,
    "coach_contract_end_date": DAY,
    "season_id": TEXT,
}
COACHES = {
    "coach_id": TEXT,
    "first_name": TEXT,
    "last_name": TEXT,
    "full_name": TEXT,
    "birth_date": DAY,
    "nationality": TEXT,
}
REFEREES = {
    "referee_id": TEXT,
    "full_name": TEXT,
    "nationality": TEXT,
}
STAGED_SEASONS = {
    "season_uid": TEXT,
    "season_id": TEXT,
    "start_date": DAY,
    "end_date": DAY,
    "competition_id": TEXT,
}
STAGED_PLAYERS = {
    "player_id": TEXT,
    "name": TEXT,
    "first_name": TEXT,
    "last_name": TEXT,
    "date_of_birth": DAY,
    "nationality": TEXT,
    "section": TEXT,
    "position": TEXT,
    "player_number": WHOLE,
    "current_team_id": TEXT,
    "contract_start_month": DAY,
    "contract_end_month": DAY,
    "last_updated_at": MOMENT,
}
MATCHES_PER_TEAM = {
    "team_match_id": TEXT,
    "match_id": TEXT,
    "competition_id": TEXT,
    "team_id": TEXT,
    "team_playing_location": TEXT,
    "match_at": MOMENT,
    "match_status": TEXT,
    "match_stage": TEXT,
    "team_result": TEXT,
}
MATCH_FACTS = {
    "team_match_id": TEXT,
    "match_id": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "team_id": TEXT,
    "team_name": TEXT,
    "team_logo_url": TEXT,
    "team_playing_location": TEXT,
    "match_at": MOMENT,
    "match_month": MOMENT,
    "team_result": TEXT,
    "match_status": TEXT,
    "match_stage": TEXT,
    "opponent_team_id": TEXT,
    "opponent_team_name": TEXT,
    "opponent_team_logo_url": TEXT,
    "home_pts": WHOLE,
    "away_pts": WHOLE,
    "total_pts": WHOLE,
    "goals_scored": WHOLE,
    "goals_conceded": WHOLE,
}
STANDINGS = {
    "current_placement_id": TEXT,
    "ranking": COUNT,
    "competition_name": TEXT,
    "competition_id": TEXT,
    "team_name": TEXT,
    "team_logo_url": TEXT,
    "team_id": TEXT,
    "home_pts": COUNT,
    "away_pts": COUNT,
    "total_pts": COUNT,
    "number_of_home_matches": COUNT,
    "number_of_away_matches": COUNT,
    "total_number_of_matches": COUNT,
    "goals_scored_at_home": COUNT,
    "goals_conceded_at_home": COUNT,
    "goals_scored_away": COUNT,
    "goals_conceded_away": COUNT,
    "total_goals_scored": COUNT,
    "total_goals_conceded": COUNT,
    "number_of_home_wins": COUNT,
    "number_of_home_draws": COUNT,
    "number_of_home_losses": COUNT,
    "number_of_away_wins": COUNT,
    "number_of_away_draws": COUNT,
    "number_of_away_losses": COUNT,
    "number_of_wins": COUNT,
    "number_of_draws": COUNT,
    "number_of_losses": COUNT,
}
VERSIONS = {
    "standings_version_id": TEXT,
    "match_id": TEXT,
    "version_start_at": MOMENT,
    "version_end_at": MOMENT,
    "team_id": TEXT,
    "team_name": TEXT,
    "team_logo_url": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "season_id": TEXT,
    "season_name": TEXT,
    "version_number_of_wins": WHOLE,
    "version_number_of_draws": WHOLE,
    "version_number_of_losses": WHOLE,
    "version_home_pts": WHOLE,
    "version_away_pts": WHOLE,
    "version_total_pts": WHOLE,
    "version_number_of_goals_scored": WHOLE,
    "version_number_of_goals_conceded": WHOLE,
    "version_total_number_of_goals_in_match": WHOLE,
    "running_number_of_wins": COUNT,
    "running_number_of_draws": COUNT,
    "running_number_of_losses": COUNT,
    "running_home_pts": COUNT,
    "running_away_pts": COUNT,
    "running_total_pts": COUNT,
    "running_number_of_goals_scored": COUNT,
    "running_number_of_goals_conceded": COUNT,
    "running_total_number_of_goals_in_matches": COUNT,
    "running_number_of_goals_scored_at_home": COUNT,
    "running_number_of_goals_scored_away": COUNT,
    "running_number_of_goals_conceded_at_home": COUNT,
    "running_number_of_goals_conceded_away": COUNT,
}
WEEKLY = {
    "week_start_date": MOMENT,
    "standings_version_id": TEXT,
    "match_id": TEXT,
    "version_start_at": MOMENT,
    "version_end_at": MOMENT,
    "team_id": TEXT,
    "team_name": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "season_id": TEXT,
    "season_name": TEXT,
    "version_number_of_wins": WHOLE,
    "version_number_of_draws": WHOLE,
    "version_number_of_losses": WHOLE,
    "version_home_pts": WHOLE,
    "version_away_pts": WHOLE,
    "version_total_pts": WHOLE,
    "version_number_of_goals_scored": WHOLE,
    "version_number_of_goals_conceded": WHOLE,
    "version_total_number_of_goals_in_match": WHOLE,
    "running_number_of_wins": COUNT,
    "running_number_of_draws": COUNT,
    "running_number_of_losses": COUNT,
    "running_home_pts": COUNT,
    "running_away_pts": COUNT,
    "running_total_pts": COUNT,
    "running_number_of_goals_scored": COUNT,
    "running_number_of_goals_conceded": COUNT,
    "running_total_number_of_goals_in_matches": COUNT,
    "running_number_of_goals_scored_at_home": COUNT,
    "running_number_of_goals_scored_away": COUNT,
    "running_number_of_goals_conceded_at_home": COUNT,
    "running_number_of_goals_conceded_away": COUNT,
    "ranking": COUNT,
}
STREAKS = {
    "streak_id": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "team_id": TEXT,
    "team_name": TEXT,
    "team_logo_url": TEXT,
    "streak_match_ids": LIST,
    "streak_match_ats": MOMENTS,
    "streak_number_of_matches": COUNT,
    "streak_type": TEXT,
    "streak_start_match_id": TEXT,
    "streak_end_match_id": TEXT,
    "streak_start_at": MOMENT,
    "streak_end_at": MOMENT,
}
PLAYERS = {
    "player_id": TEXT,
    "name": TEXT,
    "date_of_birth": DAY,
    "age": COUNT,
    "nationality": TEXT,
    "section": TEXT,
    "position": TEXT,
    "player_number": WHOLE,
    "team_id": TEXT,
    "team_name": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "contract_start_month": DAY,
    "contract_end_month": DAY,
}
SEASONS = {
    "season_id": TEXT,
    "start_date": DAY,
    "end_date": DAY,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "season_name": TEXT,
}
PLAYOFFS = {
    "match_id": TEXT,
    "match_at": MOMENT,
    "status": TEXT,
    "matchday_number": WHOLE,
    "match_stage": TEXT,
    "home_team_id": TEXT,
    "home_team_name": TEXT,
    "home_team_logo_url": TEXT,
    "away_team_id": TEXT,
    "away_team_name": TEXT,
    "away_team_logo_url": TEXT,
    "referees_ids": LIST,
    "winner": TEXT,
    "duration_type": TEXT,
    "full_time_home_score": WHOLE,
    "full_time_away_score": WHOLE,
    "half_time_home_score": WHOLE,
    "half_time_away_score": WHOLE,
    "area_id": TEXT,
    "competition_id": TEXT,
    "competition_name": TEXT,
    "season_id": TEXT,
    "last_updated_at": MOMENT,
    "stage_order": WHOLE,
}
COUNTRIES = {
    "country_id": TEXT,
    "area_id": TEXT,
    "country_name": TEXT,
    "country_code": TEXT,
    "continent_id": TEXT,
}
CONTINENTS = {
    "continent_id": TEXT,
    "continent_name": TEXT,
}
CALENDAR = {
    "date_day": MOMENT,
    "date_week": COUNT,
    "week_start_date": MOMENT,
    "week_end_date": MOMENT,
    "date_month": COUNT,
    "month_name": TEXT,
    "month_short_name": TEXT,
    "date_year": COUNT,
}
