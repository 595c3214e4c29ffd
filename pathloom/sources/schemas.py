"""Explicit schemas of the files that rollouts and converted datasets are made of."""

from __future__ import annotations


def _struct(**fields: str) -> str:
    """Column definitions as Spark's readers take them; no session is needed to name them."""
    return ", ".join(f"`{k}` {v}" for k, v in fields.items())


_GUARD = "struct<version:string,enabled:boolean,start_distance:double,stop_distance:double,approach_gain:double,closing_margin:double,prediction_horizon:double,emergency_distance:double,min_retreat_speed:double,max_tangent_speed:double,max_yaw_speed:double,max_human_speed:double,leader_rvo_radius_scale:double>"
EPISODE_RESULT = _struct(
    finish="boolean", status="string", following_rate="double", following_step="bigint", total_step="bigint", collision="double", oracle_robot_teacher="boolean", dyn_obstacle_avoid="boolean",
    main_human_proximity_guard="boolean", main_human_guard_config=_GUARD, avoid_other_pedestrians="boolean", avoid_backend="string", ctrl_freq="bigint", fps="bigint", scene_id="string", episode_id="string",
    robot_type="string", task_type="string", task_subtype="string", instruction="string", data_debug="boolean", last_human_following="boolean", human_following_success="boolean", success_visible_detector="boolean",
    success="string", used_success_snapshot="boolean", saved_full_episode="boolean", agent_1_base_velocity="struct<longitudinal_lin_speed:double,lateral_lin_speed:double,ang_speed:double>",
)
STEP_LOG = _struct(
    frame_index="bigint", timestamp="double", step="bigint", robot_pos="array<double>", robot_yaw="double", human_pos="array<double>", human_yaw="double", robot_pos_after="array<double>", robot_yaw_after="double",
    human_pos_after="array<double>", human_yaw_after="double", base_velocity_physical="array<double>", action="array<double>", target_pose="array<double>", base_velocity="array<double>", action_available="boolean",
    facing="double", human_following="double", dis_to_human="double", collision="double", human_collision="double", base_velocity_raw="array<double>", dyn_obs_correction="double", main_human_guard_correction="double",
    main_human_guard_speed_limit="double", main_human_guard_distance="double", main_human_guard_predicted_distance="double", main_human_guard_human_radial_speed="double", main_human_guard_toward_speed="double",
    main_human_guard_toward_speed_limit="double", main_human_guard_toward_speed_after="double", main_human_guard_emergency="boolean",
)
FAILURE_EVENT = _struct(
    timestamp="string", split_id="bigint", scene_key="string", episode_id="string", status="string", following_rate="double", total_step="bigint", failure_reasons="array<string>", failure_reason_messages="array<string>",
    recent_steps="array<struct<step:bigint,dis_to_human:double,human_following:double,human_collision:double>>",
)
EPISODE_DATASET = _struct(
    episodes="array<struct<episode_id:string,scene_id:string,start_position:array<double>,start_rotation:array<double>,goals:array<struct<position:array<double>,radius:double>>,goals_key:string,info:map<string,double>,instruction:struct<instruction_text:string>,question:struct<question_text:string,answer_text:string>>>",
    instruction_vocab="struct<word_list:array<string>>", question_vocab="struct<word_list:array<string>>", goals_by_category="map<string,array<struct<position:array<double>,radius:double>>>",
)
_GOALS = "array<struct<object_category:string,object_id:string,position:array<double>,radius:double,view_points:array<struct<agent_state:struct<position:array<double>,rotation:array<double>>,iou:double>>>>"
GOAL_DATASET = _struct(
    category_to_task_category_id="map<string,bigint>", category_to_scene_annotation_category_id="map<string,bigint>", category_to_mp3d_category_id="map<string,bigint>", goals_by_category=f"map<string,{_GOALS}>",
    episodes=f"array<struct<scene_id:string,object_category:string,start_position:array<double>,start_rotation:array<double>,info:map<string,double>,goals:{_GOALS}>>",
)
TASKS = _struct(task_index="bigint", task="string", task_type="string", task_subtype="string", platform_text="string", dataset_source="string", scene_id="string", answer="string")
CONTEXT_META = _struct(context_key="string", dataset="string", split="string", episode_index="bigint", episode_id="string", frame_index="bigint", index="bigint", offset="bigint", n_blocks="bigint", total_tokens="bigint")
REFS = _struct(ref_id="bigint", ref="string", episode_id="string", frame_index="bigint", camera_name="string")
HUMANOIDS = _struct(name="string", betas="array<double>", gender="string", texture="string", semantic_id="bigint")
