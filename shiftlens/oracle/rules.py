"""Rules of the built-in lines as the checks state them, on their own, so that an edit of the configuration shows."""

from __future__ import annotations

# Lines, excluded days, segments and clusters in matching order, categories and SPC panels.
LINES = (("line_a", "Line A"), ("line_b", "Line B"))
EXCLUDED_DAYS = (("line_a", "2024-01-14"), ("line_a", "2024-01-25"))
# line, segment, label, colour, codes from, codes below, words in a label
SEGMENTS = (
    ("line_a", "hydration", "Hydration", "#e76f51", 0, 2000, r"catheter|gripper|PMK|hydration|cover holder|\bfoam\b|\bdosing\b|nozzle|stn080|inject\s*pressure"),
    ("line_a", "foil", "Foil", "#e9c46a", 2000, 3000, r"printer|labeler|pouch|edge\s*trim|sealing|foil"),
    ("line_a", "schubert", "Schubert", "#2a9d8f", 3000, 9999, r"schubert|frame [a-z]|closing area"),
    ("line_a", "manual", "Manual", "#636e72", None, None, None),
    ("line_a", "unattributed", "Other", "#b2bec3", None, None, None),
    ("line_b", "web", "Web / Reel", "#3B82F6", None, None, r"reel|web torn|splice|all rolls empty|vacuum splice"),
    ("line_b", "sealing", "Sealing", "#F59E0B", None, None, r"sealing head|temperature|knife|hot printer|current limit"),
    ("line_b", "handling", "Handling", "#8B5CF6", None, None, r"gripper|fork|pickup position|push.?out piston|parallel gripper|cylinder switch"),
    ("line_b", "pneumatic", "Pneumatic", "#10B981", None, None, r"valve|air valve|flow monitor|cooling"),
    ("line_b", "manual", "Manual", "#636e72", None, None, None),
    ("line_b", "unattributed", "Other", "#b2bec3", None, None, None),
)
# line, segment, cluster, pattern
CLUSTERS = (
    ("line_a", "hydration", "Gripper", r"gripper|funnel"),
    ("line_a", "hydration", "Catheter Reject", r"catheter|rejected"),
    ("line_a", "hydration", "Foam", r"\bfoam\b|\bdosing\b|nozzle|stn080|inject\s*pressure"),
    ("line_a", "hydration", "PMK / Media", r"\bPMK\b|empty.*mode"),
    ("line_a", "hydration", "Timing", r"takes longer|maximum allowed|\bMSM\b"),
    ("line_a", "hydration", "Cover", r"cover holder"),
    ("line_a", "hydration", "Cap", r"\bcap\b"),
    ("line_a", "hydration", "Limit Switch", r"limit switch"),
    ("line_a", "foil", "Printer", r"printer"),
    ("line_a", "foil", "Labeler", r"labeler"),
    ("line_a", "foil", "Edge Trim", r"edge\s*trim|trim broken"),
    ("line_a", "foil", "Scanner", r"laser scanner|scanner"),
    ("line_a", "foil", "Positioning", r"position|product not in"),
    ("line_a", "foil", "Sealing Lane", r"sealing\s*lane"),
    ("line_a", "foil", "Detection Fault", r"detection\s*fault|reject\s*fault"),
    ("line_a", "schubert", "Line Stop / Wait", r"waiting|line stop|downstream"),
    ("line_a", "schubert", "Frame", r"frame"),
    ("line_a", "schubert", "Closing", r"closing"),
    ("line_b", "web", "End of Reel", r"end of reel|prewarning.*reel|all rolls empty"),
    ("line_b", "web", "Web Torn", r"web torn"),
    ("line_b", "web", "Splice", r"splice|splice module|last splice"),
    ("line_b", "sealing", "Sealing Head", r"sealing head|current limit"),
    ("line_b", "sealing", "Temperature", r"temperature"),
    ("line_b", "sealing", "Knife", r"knife"),
    ("line_b", "sealing", "Printer", r"hot printer"),
    ("line_b", "handling", "Gripper", r"gripper|pickup position|parallel gripper"),
    ("line_b", "handling", "Fork", r"fork"),
    ("line_b", "handling", "Piston", r"push.?out piston"),
    ("line_b", "handling", "Cylinder", r"cylinder switch"),
    ("line_b", "pneumatic", "Air Pressure", r"air valve"),
    ("line_b", "pneumatic", "Valve on Web", r"valve.*web|valve.*inserted|valve.*area"),
    ("line_b", "pneumatic", "Cooling", r"cooling|flow monitor"),
)
CATEGORIES = (
    ("micro_stops", "Micro-stops (<2 min)", "#2d3436"),
    ("halted", "Halted (operator wait)", "#636e72"),
    ("auto_long", "Auto-stops (>2 min)", "#b2bec3"),
    ("manual", "Manual stops", "#dfe6e9"),
)
# line, panel, short name, counter table, lanes, divisor, least resets, least subgroups, lane names, lane that is watched for resets, two stations, active lanes only, stations
PANELS = (
    ("line_a", "nozzle_spc", "Nozzle", "hydration_counters", 10, 10, 10, 10, "name_template",
     None, False, False, ("Stn080_Foam dosing_1_12_%",)),
    ("line_a", "camera_spc", "Camera", "hydration_counters", 10, 10, 5, 5, "synthetic",
     "Stn012_Camera align cap rear_1_7_2", True, True, ("Stn012_Camera align cap rear_1_7_%", "Stn031_Camera align cap front_1_9_%")),
    ("line_a", "vision_spc", "Vision", "foil_counters", 5, 5, 10, 10, "discovered_sorted",
     None, False, False, ("%St_041 Vision system printing%",)),
)
