"""Plain-Python statement of what flattening and decoding have to give, for comparison only."""

TEXT_TYPES = {"string": "valueString", "time": "valueTime", "selectionMark": "valueSelectionMark"}


def rows_of(tree):
    found = []

    def visit_map(entries, path, index):
        for key, node in entries.items():
            if isinstance(node, dict):
                visit(node, f"{path}.{key}" if path else key, key, path, index)

    def visit(node, path, name, parent, index):
        kind = node.get("type") or "string"
        if kind == "object":
            inner = node.get("valueObject")
            visit_map(inner if isinstance(inner, dict) else {}, path, index)
        elif kind == "array":
            for i, item in enumerate(node.get("valueArray") or []):
                if isinstance(item, dict):
                    visit(item, f"{path}[{i}]", f"{name}[{i}]", path, i)
        else:
            found.append((path, name, parent, index, kind, text_of(node, kind), node.get("confidence")))

    visit_map(tree, None, None)
    return found


def text_of(node, kind):
    keys = {**TEXT_TYPES, "number": "valueNumber", "integer": "valueInteger", "boolean": "valueBoolean"}
    value = node.get(keys[kind]) if kind in keys else node.get("valueString")
    if value is None:
        return "" if node.get("confidence") is not None else None
    return str(value)
