"""All registered queries."""

import checks.scalars  # noqa: F401
import checks.ingest  # noqa: F401
import checks.exact  # noqa: F401
import checks.fuzzy  # noqa: F401
import checks.golden  # noqa: F401
import checks.streams  # noqa: F401
