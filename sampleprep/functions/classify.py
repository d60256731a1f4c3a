"""Question classification: an ordered list of rules, the first that matches wins."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleprep.functions.text import normalise_question

# The rules in their order. A rule is a line "# task scope" and its question templates; the scope is multi,
# single, or count (by the number of images). A word in brackets stands for any text.
RULE_TEXT = """
# correspondence multi
which matches the original?
which one matches the original?
which point matches the original?
can you identify the corresponding point?
Does the [A] in image 1 show up in image 2?
Can you find the [A] from image 1 in image 2?
Is the [A] from the first image visible in the second image?
Is the [A] in image 1 different from any object in image 2?
# position multi
If the [A] is [X] of the [B] in image 1, what direction is the [C] (visible in image 2) from the [B]?
If the [A] is to the [X] of the [B] in the first image, what direction is the [C] from the [B]?
Given that the [A] appears [X] relative to the [B] in image 1, which direction does the [C] (seen in image 2) lie with respect to the [B]?
In image 1, if the [A] is located [X] of the [B], what direction does the [C] (depicted in image 2) take from the [B]?
If the [A] is positioned [X] relative to the [B] in the first image, how would you describe the direction of the [C] (visible in image 2) in relation to the [B]?
What direction does the [C] (shown in image 2) occupy from the [B], given that the [A] is [X] to the [B] in image 1?
If I am at the position of the [B] in image 1, and the [A] is on the [X] side of me, what direction is the [C] (visible in image 2) from my position?
Standing at the location of the [B] in the first image, with the [A] is on my [X] side, which direction does the [C] (seen in image 2 ) lie from me?
From the viewpoint of the [B] in image 1, if the [A] is located at the [X] side of me, what direction does the [C] (depicted in image 2) take from my position?
If I consider myself at the [B]'s position in the first image, and the [A] is positioned at the [X] side of me, how would I describe the direction of the [C] (visible in image 2) from my location?
Assume I am at the [B]'s position in image 1, with the [A] on my [X] side, what direction does the [C] (shown in image 2) occupy from my viewpoint?
From the perspective of the [B] in the first image, if the [A] is on the [X] side of the [B], which direction is the [C] (visible in image 2) from the [B]'s position?
# 3d_scene_caption single
Create comprehensive spatial relationship descriptions that capture every observable detail in 100-200 words.
Generate systematic visual documentation focusing on spatial relationships of object positions in 100-200 words.
Develop detailed scene inventories that catalog all visible elements and their spatial relationships in 100-200 words.
Produce structured spatial layout analysis report containing both descriptive text and technical metadata in 100-200 words.
Construct thorough image assessments covering spatial, temporal, and contextual elements in 100-200 words.
# distance multi
Given the multi-view images and objects: [T], which one is the farthest from the [X]?
Considering the multi-view images and the set of objects [T], which object is most distant from [X]?
From the provided multi-view images and objects [T], identify the object that is the farthest from [X].
Among the objects [T] shown in the multi-view images, which one has the greatest distance from [X]?
From the multi-view objects [T], identify the one farthest from [X].
Out of the objects [T] in the multi-view images, which one is the most distant from [X]?
If you view objects [T] from multiple perspectives, which one has the maximum distance to [X]?
Given the multi-view images and objects: [T], which one is the closest to the [X]?
Considering the multi-view images and the set of objects [T], which object is nearest to [X]?
From the provided multi-view images and objects [T], identify the object that is the closest to [X].
Among the objects [T] shown in the multi-view images, which one has the smallest distance from [X]?
From the multi-view objects [T], identify the one closest to [X].
Out of the objects [T] in the multi-view images, which one is the nearest to [X]?
If you view objects [T] from multiple perspectives, which one has the minimum distance to [X]?
View 1 and View 2 are two different views that represent the same scene. In which view the [A] in the scene is [Y] to the spot where the camera view was positioned?
Two views (View 1 and View 2) show the same scene from different angles. In which view is the [A] [Y] to the camera position?
Given View 1 and View 2 of the same scene, in which view does the [A] appear [Y] to where the camera was placed?
The same scene is captured in View 1 and View 2. In which view is the [A] [Y] to the camera viewpoint?
# size multi
Given the multi-view images and the objects: [T], which one is the biggest?
Considering the set of objects: [T] in the multi-view images, identify the one with the largest size.
From the provided objects: [T] in different perspectives, which object has the greatest size?
Out of the objects: [T], which one is the largest in size?
From the collection of objects: [T] in different views, determine which is the biggest.
Given the multi-view images and the objects: [T], which one is the smallest?
Considering the set of objects: [T] in the multi-view images, identify the one with the smallest size.
From the provided objects: [T] in different perspectives, which object has the least size?
Out of the objects: [T], which one is the smallest in size?
From the collection of objects: [T] in different views, determine which is the smallest.
Given two different views, Is the [A] bigger than the [B]?
As shown in different views, does the [A] have a larger size compared to the [B]?
After reviewing the images, can you confirm if the [A] is bigger than the [B]?
Based on the given images, is the [A] smaller than the [B]?
Considering the different perspectives of the scene, does the [A] have a smaller size compared to the [B]?
After reviewing the images, can you confirm if the [A] is smaller than the [B]?
# grounding_3d single
Identify the 3D bounding box surrounding the [A] within this environment.
Locate the 3D bounding volume for the [A] present in the scene.
Find the 3D bounding box that encapsulates the [A] in this visual representation.
Extract the 3D bounding box coordinates of the [A] located in the image.
Outline the 3D bounding box for the [A] visible in this setting.
Pinpoint the 3D bounding box enclosing the [A] in this layout.
Trace the edges of the 3D bounding box around the [A] in this scenario.
Highlight the 3D bounding box that frames the [A] observed in the image.
Predict the 3D location of the [A] observed in the image.
Output a json list where each entry contains the object name in "label" and its 3D bounding box in "bbox_3d".
Determine the dimensions of the 3D bounding box for the [A] in this context.
Calculate the 3D bounding box dimensions for the [A] depicted in the scene.
# depth single
Given the [T] [A], please order them by depth (from near to far).
Please arrange the [T] [A] based on their depth (from near to far).
Order the [T] [A] according to their depth from near to far.
Sort the [T] [A] by depth (from near to far).
Can you organize the [T] [A] in order of their depth (from near to far)?
Please sequence the [T] [A] from shallowest to deepest .
Between the [T] [A], which one is the [B] closest to the camera?
Among the [T] [A], which one is the [B] nearest to the camera?
From the [T] [A], identify the one that is the [B] closest to the camera.
Considering the [T] [A], which one is the [B] nearest to the camera?
Out of the [T] [A], which one has the [B] smallest depth?
Between the [T] [A], which one is the farthest from the camera?
Among the [T] [A], which one is the most distant from the camera?
From the [T] [A], identify the one that is the farthest from the camera.
Considering the [T] [A], which one is the most distant from the camera?
Out of the [T] [A], which one has the greatest depth?
From the [T] [A], which is the one with the largest depth?
From the [T] [A], which one is the one with the largest depth?
Between the [T] [A], which one is the closest to the camera?
Among the [T] [A], which one is the nearest to the camera?
From the [T] [A], identify the one that is the closest to the camera.
Considering the [T] [A], which one is the nearest to the camera?
Out of the [T] [A], which one has the smallest depth?
From the [T] [A], which one is the one with the least depth?
# counting single
Find out how many [A](s) in this scene.
What is the number of the [A](s)?
How many [A](s) are there?
Could you tell me the number of the [A](s)?
Counting the number of [A](s) in this scene?
How many [A](s) can you see?
How many [A](s) are present?
What is the count of the [A](s)?
Can you provide the count of the [A]?
Please count the number of [A].
# size single
What is the length of the dimension that is largest in size (length, width, or height) of the [A]? [D]
What is the measurement for the longest side (length, width, or height) of the [A]? [D]
Can you provide the size of the [A]'s largest dimension (length, width, or height)? [D]
What is the length of the dimension that is maximum (length, width, or height) of the [A]? [D]
What is the length of the dimension that is the greatest (length, width, or height) of the [A]? [D]
What is the measurement of the [A]'s longest dimension (length, width, or height)? [D]
Can you tell me the size of the [A]'s maximum dimension (length, width, or height)? [D]
What is the length of the dimension that is the most extensive (length, width, or height) of the [A]? [D]
What is the measurement of the [A]'s greatest dimension (length, width, or height)? [D]
Can you provide the size of the [A]'s most significant dimension (length, width, or height)? [D]
Could you estimate the height of the [A]? [D]
What is the vertical measurement of the [A]? [D]
Can you provide the height dimension of the [A]? [D]
How tall does the [A] stand? [D]
What is the height of the [A]? [D]
Could you tell me the vertical size of the [A]? [D]
What is the measurement of the [A]'s height? [D]
Can you estimate how high the [A] is? [D]
What is the vertical dimension of the [A]? [D]
Is the [A] bigger than the [B]?
Does the [A] have a larger size compared to the [B]?
Can you confirm if the [A] is bigger than the [B]?
Is the [A] smaller than the [B]?
Does the [A] have a smaller size compared to the [B]?
Can you confirm if the [A] is smaller than the [B]?
# distance count
Measuring from the closest point of each object, what is the distance between the [A] and the [B] (in meters)?
Measuring from the closest point of each object, what is the distance between the [A] and the [B] (in centimeters)?
What is the distance between the [A] and the [B] (in meters)?
What is the distance between the [A] and the [B] (in centimeters)?
Consider the real-world 3D location of the objects. What is the distance between the [A] and the [B] (in meters)?
Consider the real-world 3D location of the objects. What is the distance between the [A] and the [B] (in centimeters)?
Estimate the real-world distances between objects in this image. Which object is farther from the [C], the [A] or the [B]? [O]
Based on the spatial arrangement of objects in this image, which object is more distant from the [C], the [A] or the [B]? [O]
Considering the 3D positions of objects in this image, which one is farther from the [C], the [A] or the [B]? [O]
From the perspective of this image, which object is more distant from the [C], the [A] or the [B]? [O]
Looking at the spatial layout in this image, which object is farther from the [C], the [A] or the [B]? [O]
Which of [A] and [B] is farther to [C]? [O]
Estimate the real-world distances between objects in this image. Which object is closer to the [C], the [A] or the [B]? [O]
Based on the spatial arrangement of objects in this image, which object is nearer to the [C], the [A] or the [B]? [O]
Considering the 3D positions of objects in this image, which one is closer to the [C], the [A] or the [B]? [O]
From the perspective of this image, which object is nearer to the [C], the [A] or the [B]? [O]
Looking at the spatial layout in this image, which object is closer to the [C], the [A] or the [B]? [O]
Which of [A] and [B] is closer to [C]? [O]
# position single
Consider the real-world 3D locations of the objects. Which object has a higher location? [O]
Based on the 3D positions of the objects, which one is placed at a higher elevation? [O]
Looking at the real-world 3D arrangement, which object is positioned higher? [O]
Considering the spatial positions of the objects in 3D space, which one sits higher? [O]
Consider the real-world 3D locations of the objects. Which object has a lower location? [O]
Based on the 3D positions of the objects, which one is placed at a lower elevation? [O]
Looking at the real-world 3D arrangement, which object is positioned lower? [O]
Considering the spatial positions of the objects in 3D space, which one sits lower? [O]
Consider the real-world 3D locations of the objects. Are the [A] and the [B] next to each other or far away from each other? [O]
Based on the 3D spatial arrangement, are the [A] and the [B] close together or far apart? [O]
Looking at the real-world positions of the objects, are the [A] and the [B] near each other or distant? [O]
Considering the spatial layout, would you say the [A] and the [B] are adjacent or separated by a large distance? [O]
# position count
left-hand side
right-hand side
on the left of
on the right of
to the left of
to the right of
which is above
which is below
which one is above
which one is below
is it above
is it below
is it on the left
is it on the right
# camera_motion multi
first-person perspective
horizontal translation
vertical translation
camera movement
camera translate
"""

#: Columns and metadata keys that name a category, in order.
CATEGORY_KEYS = ("category", "sub_category", "subcategory", "ability", "task", "label")

_SPECIAL = re.compile(r"([.^$*+?()\[\]{}|\\])")


def rules() -> list[tuple[str, str, list[str]]]:
    """(task, scope, templates) in order."""
    made: list[tuple[str, str, list[str]]] = []
    for line in RULE_TEXT.strip().splitlines():
        if line.startswith("# "):
            _, task, scope = line.split()
            made.append((task, scope, []))
        else:
            made[-1][2].append(line)
    return made


def pattern_of(template: str) -> str:
    """A regular expression, alike in Java, RE2 and Python, for a template; to be searched in a normalised question."""
    literals = re.split(r"\[[a-z0-9]+\]", " ".join(template.lower().split()))
    parts = [_SPECIAL.sub(r"\\\1", text).replace(r"\(s\)", r"(?:\(s\))?") for text in literals]
    if len(parts) > 1 and not parts[-1] and parts[-2].endswith(" "):
        parts[-2] = parts[-2][:-1]  # nothing needs to follow a question that ends in an option list
    return ".*".join(parts)


def rule_patterns() -> list[tuple[str, str, str]]:
    """(task, scope, one pattern for all of a rule's templates) in order."""
    return [(task, scope, alternatives(templates)) for task, scope, templates in rules()]


def alternatives(templates: list[str]) -> str:
    return "|".join(f"(?:{pattern_of(t)})" for t in templates)


def literal_words(template: str) -> set[str]:
    """The words that a question which meets the template must have in it, as parts of its words at least."""
    literals = re.split(r"\[[a-z0-9]+\]", " ".join(template.lower().split()))
    words = {w.replace("(s)", " ") for text in literals for w in text.split()}
    return {part for w in words for part in w.split()}


def anchors() -> list[dict[str, list[str]]]:
    """For each rule, words by the templates they stand for: each template has one of its words, rare in other rules and shared in its own.

    Words are picked greedily: the one that stands for most of the rule's templates left, weighed against how many of all templates have it.
    """
    made = rules()
    seen = Counter(w for _, _, templates in made for t in templates for w in literal_words(t))
    found = []
    for _, _, templates in made:
        left, picked = list(templates), {}
        while left:
            here = Counter(w for t in left for w in literal_words(t))
            best = max(here, key=lambda w: (here[w] * len(w) / (1 + seen[w] - here[w]), w))
            picked[best] = [t for t in left if best in literal_words(t)]
            left = [t for t in left if best not in literal_words(t)]
        found.append(picked)
    return found


def infer_category(question: Column, n_images: Column) -> Column:
    """task.multi_view or task.single_view of the first rule found in the question; defaults by the number of images.

    A rule's templates are tried only where the question has the anchor word that stands for them.
    """
    by_count = F.when(n_images > 1, "multi_view").otherwise("single_view")
    views: dict[str, Callable[[str], Column]] = {
        "multi": lambda task: F.lit(f"{task}.multi_view"),
        "single": lambda task: F.lit(f"{task}.single_view"),
        "count": lambda task: F.concat(F.lit(f"{task}."), by_count),
    }
    words = anchors()

    def first_rule(q: Column) -> Column:
        found = F.when(q == "", F.concat(F.lit("unknown."), by_count))
        for (task, scope, _), picked in zip(rules(), words, strict=True):
            met = None
            for word, templates in picked.items():
                one = F.contains(q, F.lit(word)) & q.rlike(alternatives(templates))
                met = one if met is None else met | one
            found = found.when(met, views[scope](task))
        return found.otherwise(F.when(n_images > 1, "camera_motion.multi_view").otherwise("position.single_view"))

    # the question is normalised once for the row
    return F.get(F.transform(F.array(normalise_question(F.coalesce(question, F.lit("")))), first_rule), 0)


def _first_present(found: list[tuple[str, Column]]) -> Column:
    """The first (field, value) whose value is neither null nor empty, else null; each value is worked out once."""
    pairs = F.array(*[F.struct(F.lit(field).alias("field"), value.alias("value")) for field, value in found])
    return F.get(F.filter(pairs, lambda x: x["value"] != ""), 0)


def resolve_category(columns: list[str], meta_json: Column | None, inferred: Column) -> tuple[Column, Column]:
    """(field, value): a category column, else a key of the metadata object, else of the first array element that has one, else inferred.

    columns: the table's; metadata that isn't JSON counts as none, and is parsed once.
    """

    def of_keys(value: Column, prefix: str) -> Column:
        return _first_present([(f"{prefix}.{k}", F.try_variant_get(value, f"$.{k}", "string")) for k in CATEGORY_KEYS])

    def of_meta(meta: Column) -> Column:
        kind = F.schema_of_variant(meta)
        items = F.transform(F.try_variant_get(meta, "$", "array<variant>"), lambda item: of_keys(item, "meta_info[]"))
        first = F.get(F.filter(items, lambda x: x.isNotNull()), 0)
        return F.when(F.startswith(kind, F.lit("OBJECT")), of_keys(meta, "meta_info")).when(F.startswith(kind, F.lit("ARRAY")), first)

    given = [(k, F.col(k).cast("string")) for k in CATEGORY_KEYS if k in columns]
    steps = [_first_present(given)] if given else []
    if meta_json is not None:
        steps.append(F.get(F.transform(F.array(F.try_parse_json(meta_json)), of_meta), 0))
    steps.append(F.struct(F.lit("inferred_subtask_from_prompt").alias("field"), inferred.alias("value")))
    found = F.coalesce(*steps)
    return found["field"], found["value"]
