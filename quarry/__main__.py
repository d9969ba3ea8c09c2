from quarry.cli import main

raise SystemExit(main())
